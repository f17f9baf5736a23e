"""The training-data operators against brute force, and on awkward input."""

import math
import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrig.llm.canonical import LOOK_ALIKES, _tables, canonical, canonical_documents, look_alike_classes, look_alike_pairs
from tallyrig.llm.leaks import leaked_passages, sketches, words
from tallyrig.llm.mixing import apportion, mix_shares, mix_sources, token_count
from tallyrig.llm.multiselect import combined_percentiles, percentiles, summarise
from tallyrig.llm.nearest import nearest_by_time
from tallyrig.llm.runs import collapse_runs
from tallyrig.llm.splits import components, grouped_split
from tallyrig.session import written


def test_nearest_equals_brute_force(spark, rows):
    rng = random.Random(1)
    left, right = [], []
    for e in ("a", "b", "hot"):
        for i in range(400 if e == "hot" else 60):
            left.append((e, f"m{i % 2}", i, rng.choice([round(rng.uniform(-300, 3000), 2), round(rng.uniform(0, 50)) * 10.0]), "x"))
            right.append((e, i, rng.choice([round(rng.uniform(-300, 3000), 2), round(rng.uniform(0, 50)) * 10.0]), "y"))
    odd = [None, float("nan"), float("inf"), -float("inf")]
    left += [("a", "m9", i, t, "x") for i, t in enumerate(odd)] + [(None, "m", 1, 1.0, "x"), ("only left", "m", 1, 1.0, "x")]
    right += [("a", 900 + i, t, "y") for i, t in enumerate(odd)] + [(None, 1, 1.0, "y"), ("a", None, 1.0, "y")]
    want = set()
    for e, m, i, t, _ in left:
        if e is None or t is None or not math.isfinite(t):
            continue
        near = [(round(abs(u - t), 6), u, r) for x, r, u, _ in right if x == e and r is not None and u is not None and math.isfinite(u) and round(abs(u - t), 6) <= 20]
        if near:
            want.add((e, m, i, min(near)[2]))
    ls = spark.createDataFrame(left + left[:50], "e string, m string, i long, timestamp_ms double, right_id string")
    rs = spark.createDataFrame(right + right[:50], "e string, r long, timestamp_ms double, m string")
    for cells in (2, 10):
        got = rows(nearest_by_time(ls, rs, "e", ["m", "i"], "r", 20.0, cells=cells).drop("lag"))
        assert len(got) == len(set(got)) and set(got) == want
    assert nearest_by_time(ls.limit(0), rs, "e", ["m", "i"], "r", 20.0).count() == 0
    assert nearest_by_time(ls, rs.limit(0), "e", ["m", "i"], "r", 20.0).count() == 0


def test_runs_equal_brute_force(spark, rows):
    rng = random.Random(2)
    data = []
    for e in ("a", "hot", "one"):
        x = y = 0.0
        for i in range({"a": 40, "hot": 300, "one": 1}[e]):
            if rng.random() < 0.15:
                x, y = round(rng.random(), 3), round(rng.random(), 3)
            odd = rng.random()
            data.append((e, i, i * 10.0 if odd > 0.05 else rng.choice([None, float("nan")]), x if odd < 0.97 else None, y if odd < 0.99 else float("nan")))
    want = []
    for e in ("a", "hot", "one"):
        line = [d for d in data if d[0] == e]
        run = [line[0]]
        for before, now in zip(line, line[1:]):
            near = all(p is not None and q is not None and abs(p - q) < 0.001 for p, q in zip(before[3:], now[3:]))
            if near:
                run.append(now)
            else:
                want.append(run)
                run = [now]
        want.append(run)

    def event(run):
        ts = [d[2] for d in run if d[2] is not None and not math.isnan(d[2])]
        return (run[0][0], run[0][1], run[-1][1], len(run), min(ts) if ts else -1.0, max(ts) if ts else -1.0, max(ts) - min(ts) if ts else -1.0)

    shuffled = data + rng.sample(data, 60) + [(None, 1, 1.0, 1.0, 1.0), ("a", None, 1.0, 1.0, 1.0)]
    rng.shuffle(shuffled)
    # columns whose names clash with those the operator uses inside
    df = spark.createDataFrame(shuffled, "e string, o long, t double, s0 double, c double")
    for chunk in (4, 7, 64, 8192):
        got = rows(collapse_runs(df, "e", "o", ["s0", "c"], 0.001, "t", chunk_rows=chunk).na.fill(-1.0))
        assert got == sorted(event(r) for r in want)
    assert collapse_runs(df.limit(0), "e", "o", ["s0"], 0.001).count() == 0


def quantile(values, q):
    values = sorted(values)
    pos = q * (len(values) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return values[lo] + (values[hi] - values[lo]) * (pos - lo)


def test_multiselect_is_exact_and_combines(spark):
    rng = random.Random(3)
    draw = {"hot": lambda: rng.expovariate(1e-3), "ties": lambda: rng.choice([1.0, 2.0, 2.0, -5.0]), None: lambda: rng.gauss(0, 1)}
    data = [(g, f"day{rng.randint(1, 4)}", f()) for g, f in draw.items() for _ in range(1500)]
    data += [("single", "day1", 7.0), ("hot", "day1", None), ("hot", "day2", float("nan")), ("hot", "day2", float("inf")), ("empty", "day1", None)]
    df = spark.createDataFrame(data, "v string, day string, g double").repartition(5)
    qs = [0.0, 0.01, 0.5, 0.9, 1.0]
    held = {g: [x for k, _, x in data if k == g and x is not None and math.isfinite(x)] for g in (*draw, "single")}
    for finish in (40, 100_000):  # many rounds, and none
        got = {(r.v, r.quantile): (r.n, r.value) for r in percentiles(df, ["v"], "g", qs, finish_rows=finish).collect()}
        assert got.keys() == {(g, q) for g in held for q in qs}
        for (g, q), (n, x) in got.items():
            assert n == len(held[g])
            assert x == pytest.approx(quantile(held[g], q), rel=1e-12)
    days = [summarise(df.filter(F.col("day") == f"day{d}"), ["v", "day"], "g") for d in range(1, 5)]
    merged = days[0]
    for d in days[1:]:
        merged = merged.unionByName(d)
    for r in combined_percentiles(merged, ["v"], qs, finish_rows=30).collect():
        values = held[r.v]
        lo, hi = (sorted(values)[f(r.quantile * (len(values) - 1))] for f in (math.floor, math.ceil))
        slack = r.max_relative_error * 1.000001
        assert min(lo - abs(lo) * slack, hi - abs(hi) * slack) <= r.value <= max(lo + abs(lo) * slack, hi + abs(hi) * slack)
    assert percentiles(df.limit(0), ["v"], "g", [0.5]).count() == 0
    with pytest.raises(ValueError):
        percentiles(df, ["v"], "g", [1.5])


def test_components_equal_union_find(spark, rows):
    rng = random.Random(4)
    edges = [(f"n{a}", f"n{b}") for a, b in ((rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90))]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(40)]  # a long chain
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = dict(rows(components(spark.createDataFrame(edges, "a string, b string"))))
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: min(y for y in linked if find(y) == find(x)) for x in linked}


def test_splits_keep_groups_and_shares(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        op = "hot" if i % 3 == 0 else f"op{rng.randint(0, 150)}" if i % 3 == 1 else None
        data.append((f"p{i}", op, rng.choice(["t1"] * 8 + ["t2", None]), rng.choice([True, False, None]), "x"))
        if rng.random() < 0.1:
            data.append((f"p{i}", rng.choice([op, None, f"op{rng.randint(0, 150)}"]) if rng.random() < 0.1 else op, "t1", None, "x"))
    data += data[:200] + [(None, "hot", "t1", True, "x")]
    df = spark.createDataFrame(data, "id string, component string, task string, ready boolean, split string")
    for units in (4000, 60):  # all components placed one by one, and most in bundles
        out = grouped_split(df, "id", "component", ["task", "ready"], {"train": 0.6, "validation": 0.2, "test": 0.2}, units=units).collect()
        split = {r.id: r.split for r in out}
        assert len(out) == len(split) == 3000
        by_op = {}
        for i, op, *_ in data:
            if i is not None and op is not None:
                by_op.setdefault(op, set()).add(split[i])
        assert all(len(s) == 1 for s in by_op.values())
        share = {s: sum(v == s for v in split.values()) / 3000 for s in ("train", "validation", "test")}
        assert share == pytest.approx({"train": 0.6, "validation": 0.2, "test": 0.2}, abs=0.01)
        rare = [split[i] for i in {d[0]: d for d in data if d[0] is not None and d[2] == "t2"}]
        assert rare.count("train") / len(rare) == pytest.approx(0.6, abs=0.05)
    assert grouped_split(df.limit(0), "id", "component", ["task"], {"train": 0.5, "test": 0.5}).count() == 0
    with pytest.raises(ValueError):
        grouped_split(df, "id", "component", [], {"train": 0.5})


WORDS = "ab cd ef gh ij kl mn op qr st".split()


def test_leaks_equal_brute_force(spark, rows):
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))
    items = {i: text(rng.randint(13, 60)) for i in range(12)} | {90: "too short", 91: "", 92: None}
    docs = {}
    for d in range(60):
        words = text(rng.choice([0, 5, 40, 700])).split()
        for _ in range(rng.randint(0, 2)):
            src = items[rng.randint(0, 11)].split()
            n = rng.choice([5, 12, 13, 14, 30])
            a = rng.randint(0, max(0, len(src) - n))
            at = rng.choice([0, len(words), rng.randint(0, len(words)), 240, 250])
            words[at:at] = src[a : a + n]
        docs[d] = rng.choice([" ", "\n", ", "]).join(words)
        if rng.random() < 0.3:  # changed outfit: case, full width, look-alikes, invisible characters
            docs[d] = "".join(rng.choice([c, c.upper(), chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c, {"a": "а", "c": "с", "e": "е", "o": "ο"}.get(c, c)]) for c in docs[d]).replace("1", "1​")
    docs |= {900: None, 901: "", 902: "..."}

    def words_of(t):
        out, word = [], ""
        for c in canonical(t or "").lower() + " ":
            if unicodedata.category(c)[0] in "LN":
                word += c
            else:
                out, word = out + [word] * bool(word), ""
        return out

    grams = lambda t: {tuple(w[i : i + 13]) for w in [words_of(t)] for i in range(len(w) - 12)}
    want = {(d, i): len(grams(t) & grams(u)) for d, t in docs.items() for i, u in items.items() if grams(t) & grams(u)}
    df = spark.createDataFrame([(d, t, 1) for d, t in docs.items()] + [(3, docs[3], 1), (None, items[0], 1)], "doc_id long, text string, item_id int")
    it = spark.createDataFrame([(i, t) for i, t in items.items()] + [(None, "x")], "item_id long, text string")
    for limit in ("10MB", "-1"):  # with broadcasts, and with every join shuffled
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        found = leaked_passages(df, it)
        got = {(r.doc_id, r.item_id): r.shared_windows for r in found.collect()}
        assert ("Broadcast" in found._jdf.queryExecution().executedPlan().toString()) == (limit != "-1")
        assert got == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(want) > 10
    assert leaked_passages(df.limit(0), it).count() == 0
    assert leaked_passages(df, it.limit(0)).count() == 0


def test_case_and_look_alikes_meet():
    got = [words(t) for t in ("Вот Кот МНЕ Straße", "вот кот мне STRASSE", "Bот Kот MHE straße")]
    assert got[0] == got[1] == got[2] and len(got[0]) == 4
    assert words(None) == words("") == words(" _- ") == []


def test_equal_windows_share_a_value():
    rng = random.Random(12)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    owner, values = sketches([*texts, None, ""], 6, 3)
    of = {i: {v for o, v in zip(owner, values) if o == i} for i in range(42)}
    assert sorted(zip(owner, values)) == list(zip(owner, values)) and len(set(zip(owner, values))) == len(values)
    grams = [{tuple(w[i : i + 6]) for w in [t.split()] for i in range(len(w) - 5)} for t in texts]
    assert all(of[a] & of[b] for a in range(40) for b in range(40) if grams[a] & grams[b])
    assert not of[40] and not of[41] and all(bool(of[i]) == bool(g) for i, g in enumerate(grams))


def test_apportion_is_the_one_by_one_rule():
    rng = random.Random(7)
    for _ in range(300):
        n, seats = rng.randint(0, 7), rng.randint(0, 60)
        weights = [rng.choice([0, 1, 2, 0.5, rng.random()]) for _ in range(n)]
        caps = [rng.randint(0, 40) for _ in range(n)]
        given_ = [0] * n
        for _ in range(seats):
            open_ = [i for i in range(n) if given_[i] < caps[i] and weights[i] > 0]
            if not open_:
                break
            given_[max(open_, key=lambda i: (weights[i] / (2 * given_[i] + 1), -i))] += 1
        assert apportion(weights, seats, caps) == given_


def test_mix_meets_targets_and_caps(spark):
    rng = random.Random(8)
    data = [(i, "big" if i % 3 else rng.choice(["small", "tiny", "other", None]), rng.randint(0, 40)) for i in range(4000)]
    docs = spark.createDataFrame(data + data[:100] + [(None, "big", 5)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.25, 3), ("tiny", 0.15, 2), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    for shard in (4_000_000, 2_000, 400):  # one shard, one shelf, several shelves
        mix = written(mix_sources(docs, targets, "tokens", block_tokens=100, shard_tokens=shard))
        used = mix.collect()
        assert len({r.doc_id for r in used}) == len(used)
        cap = {"big": 1, "small": 3, "tiny": 2}
        assert all(1 <= r.repeats <= cap[r.source] for r in used)
        shares = {r.source: r for r in mix_shares(mix, targets, docs).collect()}
        assert sum(r.actual_share for r in shares.values()) == pytest.approx(1, abs=1e-5)
        for s, goal in (("big", 0.6), ("small", 0.25), ("tiny", 0.15)):
            assert shares[s].actual_share == pytest.approx(goal, abs=0.03)
        assert shares["absent"].mixed_tokens == 0
    again = mix_sources(docs.repartition(3), targets, "tokens", block_tokens=100, shard_tokens=400)
    assert sorted(again.collect()) == sorted(used)  # seeded
    assert mix_sources(docs.limit(0), targets, "tokens").count() == 0
    assert mix_sources(docs, targets.limit(0), "tokens").count() == 0


def test_token_count(spark):
    got = spark.createDataFrame([("hello world",), ("",), (None,), ("x " * 50_000,)], "t string").select(token_count(F.col("t"))).collect()
    assert [r[0] for r in got][:3] == [2, 0, 0] and got[3][0] >= 50_000
    with pytest.raises(FileNotFoundError):
        token_count(F.col("t"), "/no/such/folder")


def whole(text):
    """The consistent form of a text without looking for unstable segments."""
    mapping, _ = _tables()
    once = unicodedata.normalize("NFD", text).translate(mapping)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", once).translate(mapping))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", categories=["L", "M", "N", "P", "S", "Z", "Cf"]), max_size=20))
def test_segments_equal_whole_normalisation(text):
    assert canonical(text) == whole(text)
    assert canonical(canonical(text)) == canonical(text)


def test_canonical_keeps_real_differences():
    same = [("ﬁle", "file"), ("ＡＢ１", "AB1"), ("café", "café"), ("a​b­c", "abc"), ("a b", "a b"), ("ОК", "OK"), ("ё", "ë"), ("й", "й")]
    differ = ["m²", "m2", "½", "1/2", "…", "...", "a  b", "a b", "A", "a", "–", "-", "a\nb", "①", "1"]
    assert all(canonical(a) == canonical(b) for a, b in same)
    assert len({canonical(t) for t in differ}) == len(differ)
    assert all(canonical(o) == latin for latin, others in LOOK_ALIKES.items() for o in others)


def test_look_alike_pairs(spark, rows):
    docs = [(1, "copy"), (2, "сopy"), (3, "copy"), (4, "Copy"), (5, None), (6, ""), (7, ""), (8, "co​py"), (2, "сopy"), (None, "сору"), (9, "x" * 100_000), (10, "х" + "x" * 99_999)]
    df = spark.createDataFrame([(*d, "f") for d in docs], "doc_id long, text string, form string")
    assert rows(look_alike_pairs(df)) == [(1, 2), (1, 8), (2, 3), (2, 8), (3, 8), (9, 10)]
    assert look_alike_pairs(df.limit(0)).count() == 0
    classes = {}
    for r in look_alike_classes(df).collect():
        classes.setdefault(r.class_id, {})[r.doc_id] = (r.texts, r.documents, r.links)
    three = {1: (3, 4, 2), 2: (3, 4, 3), 3: (3, 4, 2), 8: (3, 4, 3)}
    known = (three, {4: (1, 1, 0)}, {6: (1, 2, 0), 7: (1, 2, 0)}, {9: (2, 2, 1), 10: (2, 2, 1)})
    assert len(classes) == 4 and all(c in known for c in classes.values())
    assert look_alike_classes(df.limit(0)).count() == 0
    forms = {r.doc_id: r.canonical for r in canonical_documents(df).collect()}
    assert forms[5] is None and forms[6] == "" and forms[2] == "copy"
