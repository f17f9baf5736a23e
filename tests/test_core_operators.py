"""The core operators against brute force, and on awkward input."""

import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyrig.operators.eager import join_aggregate
from tallyrig.operators.grid import regular_grid
from tallyrig.operators.ordered import islands, running_sum, with_halo, with_previous
from tallyrig.operators.quantile import average_ranks, grouped_median, grouped_quantiles
from tallyrig.operators.spikes import SpikeRule, implausible_readings
from tallyrig.plans import dealt

RULE = {"x": SpikeRule(factor=10, held_rows=4, low=-2.0, high=2.0), "y": SpikeRule(factor=10, held_rows=4, low=-2.0, high=2.0, own=False)}
SCHEMA = "source string, field string, row_idx long, value double, level string"


def brute_spikes(series, rule, side=5):
    out = set()
    for source, readings in series.items():
        line = sorted((i, v) for i, v in readings.items() if v is not None and not math.isnan(v))
        v = [x for _, x in line]
        n = len(v)
        steps = [abs(a - b) for a, b in zip(v[1:], v)]
        steps = [s for s in steps if not math.isnan(s)]
        usual = median(steps) if steps else None
        for k in range(side, n - side):
            level = median(v[k - side : k + side + 1] if rule.own else v[k - side : k] + v[k + 1 : k + side + 1])
            off = abs(v[k] - level)
            spike = usual is not None and not math.isnan(off) and off > rule.factor * usual
            a = k
            while a > 0 and v[a - 1] == v[k]:
                a -= 1
            z = k
            while z + 1 < n and v[z + 1] == v[k]:
                z += 1
            held = z - a + 1 >= rule.held_rows and k > a
            if spike or held or not rule.low <= v[k] <= rule.high or math.isinf(v[k]):
                out.add((source, line[k][0]))
    return out


def test_spikes_equal_brute_force(spark):
    rng = random.Random(5)
    series = {}
    for s, length in (("hot", 400), ("b", 60), ("c", 11), ("d", 10), ("flat", 30), ("gaps", 90)):
        value, readings = 0.0, {}
        for i in range(length):
            value += rng.uniform(-0.01, 0.01)
            readings[i] = round(value, 4) if s != "flat" else 0.5
            kind = rng.random()
            if kind < 0.03:
                readings[i] = rng.choice([1.5, 3.0, float("inf"), float("-inf")])
            elif kind < (0.5 if s == "gaps" else 0.06):
                readings[i] = rng.choice([None, float("nan")])
            elif kind < 0.09 and i:
                for j in range(max(0, i - rng.randint(1, 9)), i):
                    readings[j] = readings[i]
        series[s] = readings
    data = [(s, "x", i, v, "clash") for s, r in series.items() for i, v in r.items()]
    data += rng.sample(data, 100)  # repeated rows
    data += [(None, "x", 1, 9.0, ""), ("b", "unknown", 1, 9.0, ""), ("b", "x", None, 9.0, ""), ("b", None, 3, 9.0, "")]
    rng.shuffle(data)
    df = spark.createDataFrame(data, SCHEMA)
    df = df.unionByName(df.filter("field = 'x'").withColumn("field", F.lit("y")))
    want = {(f, *r) for f in RULE for r in brute_spikes(series, RULE[f])}
    for chunk in (16, 37, 8192):  # chunks shorter and longer than a window's reach
        got = [(r.field, r.source, r.row_idx) for r in implausible_readings(df, RULE, chunk_rows=chunk).collect()]
        assert len(got) == len(set(got))
        assert set(got) == want
    assert want


def test_a_rim_is_its_own_level_only_by_rule(spark):
    line = [*range(10), *range(110, 120)]
    df = spark.createDataFrame([("s", f, i, float(v)) for f in RULE for i, v in enumerate(line)], "source string, field string, row_idx long, value double")
    wide = {f: SpikeRule(10, 4, -1e9, 1e9, own) for f, own in (("x", True), ("y", False))}
    got = sorted((r.field, r.row_idx) for r in implausible_readings(df, wide).collect())
    assert got == [("y", 9), ("y", 10)]


def test_opposite_infinities_are_no_step(spark):
    # 17 steps of 0.01, 11 of 0.1: five steps of infinity more would make 0.1 the usual one.
    line = [i * 0.01 for i in range(20)] + [math.inf, -math.inf] * 3 + [0.2 + i * 0.1 for i in range(12)]
    line[8] += 0.5
    df = spark.createDataFrame([("s", "x", i, v) for i, v in enumerate(line)], "source string, field string, row_idx long, value double")
    for chunk in (3, 8192):
        assert (8, True) in {(r.row_idx, r.spike) for r in implausible_readings(df, RULE, chunk_rows=chunk).collect()}


def test_p1_counts_a_reading_without_row_idx_as_the_last(spark, tmp_path, rows):
    lines = [("e", i, 3.0 if i == 7 else i * 0.01, i * 0.01, -5.0 if i == 7 else i * 33.0) for i in range(12)]
    lines += [("e", None, 0.12, 9.0, 396.0), ("e", None, 0.13, 9.0, 397.0), (None, 7, 9.0, 9.0, -9.0)]
    df = spark.createDataFrame(lines, "episode_path string, row_idx long, left_x double, right_z double, timestamp_ms double")
    for name in ("actions_eef_pose", "state_joint_position"):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(dealt.p1_flags(spark, str(tmp_path))) == [
        ("actions.eef_pose", "left_x", "e", 7, True, False, True),
        ("observation.state.joint_position", "timestamp_ms", "e", 7, False, False, True),
    ]


def test_spikes_of_nothing(spark):
    assert implausible_readings(spark.createDataFrame([], SCHEMA), RULE).count() == 0


def test_grouped_median_equals_python(spark, rows):
    rng = random.Random(2)
    data = [(g, rng.choice([0.0, 1e-9, rng.random(), rng.expovariate(1e-3), float("inf")])) for g in "abc" for _ in range(rng.randint(1, 90))]
    data += [("d", 7.0), ("d", 7.0), ("e", None), ("e", float("nan"))]
    got = dict(rows(grouped_median(spark.createDataFrame(data, "g string, v double"), ["g"], "v")))
    want = {g: median([v for k, v in data if k == g]) for g in "abcd"}
    assert got == pytest.approx(want)


def test_quantiles_and_ranks_equal_python(spark):
    rng = random.Random(7)
    value = lambda: rng.choice([0.0, -0.0, -1e-300, rng.gauss(0, 1), rng.gauss(0, 1e6), 3.0, -3.0, -math.inf])
    data = [(g, value()) for g in ("a", "b", None) for _ in range(rng.randint(20, 90))] + [("c", 1.5), ("d", None), ("d", math.nan)]
    df = spark.createDataFrame(data, "g string, v double")
    finite = df.filter("v > -1e300 OR v IS NULL")
    got = {r.g: (r.n, r.low, r.q) for r in grouped_quantiles(finite, ["g"], "v", {"low": 0.0, "q": 0.37}).collect()}
    for g in ("a", "b", None, "c"):
        s = sorted(v for k, v in data if k == g and v > -1e300)
        at = 0.37 * (len(s) - 1)
        q = s[int(at)] + (s[min(int(at) + 1, len(s) - 1)] - s[int(at)]) * (at - int(at))
        assert got[g] == (len(s), s[0], pytest.approx(q))
    assert set(got) == {"a", "b", None, "c"}
    for r in average_ranks(df, ["g"], "v", "rank").collect():
        if r.v is None or math.isnan(r.v):
            assert r["rank"] is None
        else:
            line = [v for k, v in data if k == r.g]
            assert r["rank"] == sum(v < r.v for v in line) + (line.count(r.v) + 1) / 2


def test_join_aggregate_equals_join(spark, rows):
    rng = random.Random(3)
    pick = lambda: rng.choice(["k1"] * 6 + ["k2", "k3", None])
    left = spark.createDataFrame([(pick(), rng.choice(["g", "h", None]), rng.choice([1, 2, None])) for _ in range(80)], "k string, g string, a int")
    right = spark.createDataFrame([(pick(), rng.choice([5, None])) for _ in range(50)], "k string, b int")
    for how in ("inner", "left"):
        got = rows(join_aggregate(left, right, ["k"], ["g"], ["a"], ["b"], how).select("g", "n_rows", "sum_a", "sum_b").na.fill("~").na.fill(-1))
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        sql = f"SELECT g, count(*), sum(a), sum(b) FROM l {how} JOIN r ON l.k = r.k GROUP BY g"
        assert got == rows(spark.sql(sql).na.fill("~").na.fill(-1))
    none = spark.createDataFrame([], left.schema)
    assert join_aggregate(none, right, ["k"], ["g"], ["a"], ["b"], "left").count() == 0
    with pytest.raises(ValueError):
        join_aggregate(left, right, ["k"], ["g"], how="cross")


def brute_grid(readings, slot=100, gap=30_000):
    out = {}
    for key, values in readings.items():
        line = sorted(values)
        for i, (t, v) in enumerate(line):
            nxt = line[i + 1][0] if i + 1 < len(line) and line[i + 1][0] - t <= gap else None
            for s in range(math.floor(t / slot), (math.floor(nxt / slot) if nxt is not None else math.floor(t / slot)) + 1):
                until = min(nxt if nxt is not None else math.inf, t + slot)
                w = max(0.0, min(until, (s + 1) * slot) - max(t, s * slot))
                n, c, a = out.get((key, s), (0, 0.0, 0.0))
                out[key, s] = (n + (s == math.floor(t / slot)), c + w, a + w * v)
    return {k: (n, round(c / slot, 6), round(a / c, 6) if c else None) for k, (n, c, a) in out.items()}


def test_grid_equals_brute_force(spark):
    rng = random.Random(4)
    readings, data = {}, []
    for key in ("a", "b"):
        t = rng.uniform(-5000, 5000)
        for _ in range(400):
            t += rng.choice([33, 40, 120, 900, 100]) * rng.random()
            if rng.random() < 0.01:
                t += rng.choice([29_000, 31_000, 45_000])
            readings.setdefault(key, []).append((round(t, 3), rng.random()))
    for key, values in readings.items():
        data += [(key, t, v, 7) for t, v in values]
    data += rng.sample(data, 60) + [("a", None, 1.0, 7), ("a", float("nan"), 1.0, 7), ("a", float("inf"), 1.0, 7)]
    df = spark.createDataFrame(data, "k string, timestamp_ms double, v double, slot int")
    want = brute_grid(readings)
    for stretch in (300, 6000):
        got = {
            (r.k, r.slot): (r.n_readings, round(r.coverage, 6), None if r.mean_value is None else round(r.mean_value, 6))
            for r in regular_grid(df, ["k"], value="v", stretch_slots=stretch).collect()
        }
        assert got.keys() == want.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k])
    assert regular_grid(df.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError):
        regular_grid(df, ["k"], stretch_slots=10)


def test_long_series_helpers(spark):
    data = [(k, i, (i * 7) % 5) for k in ("a", "b") for i in range(50)]
    df = spark.createDataFrame(data, "k string, i long, x int")
    got = {(r.k, r.i): r.prev_x for r in with_previous(df, ["k"], "i", ["x"], chunk_rows=8).collect()}
    assert got == {(k, i): (((i - 1) * 7) % 5 if i else None) for k, i, _ in data}
    sums = {(r.k, r.i): r.s for r in running_sum(df, ["k"], "i", df.x, "s", chunk_rows=8).collect()}
    assert all(s == sum((j * 7) % 5 for j in range(i + 1)) for (_, i), s in sums.items())
    found = {(r.k, r.i): r.island for r in islands(df, ["k"], "i", df.x == 0, chunk_rows=8).collect()}
    assert all(n == i // 5 + 1 for (_, i), n in found.items())
    near = with_halo(df, ["k"], "i", halo=2, chunk=8)
    assert near.filter("__native").count() == len(data)
    assert near.count() > len(data)
