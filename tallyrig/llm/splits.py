"""Train, validation and test splits that keep related records together."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrig.session import written

#: All records make about this many units of placement; a stratum has at least so many, if it has as many components.
UNITS, UNITS_A_STRATUM = 4_000, 12
#: More different label values than this are refused, never cut off.
MOST_LABELS = 20_000


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the undirected ``edges`` (``a``, ``b`` strings).

    Alternating large-star and small-star steps: each node's neighbours are tied
    to the smallest of them, until nothing changes, in a number of rounds that
    grows with the logarithm of the graph.  The edges stay distributed.
    """
    pairs = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = signature(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            down.select("u", F.col("m").alias("v"))
        )
        pairs = written(small.filter("u <> v").distinct())
        after = signature(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)


def _place(units: pd.DataFrame, totals: pd.DataFrame, shares: dict[str, float]) -> pd.DataFrame:
    """Iterative stratification of units: ``unit, split``.

    ``units`` has ``unit, label, n`` with the label '' for all records of a unit.
    The label with fewest records outstanding comes first; of its units the one
    that holds most of it, into the split that needs the label most and has room.
    """
    names = list(shares)
    sizes: dict[str, int] = {}
    labels: dict[str, dict[str, int]] = {}
    for unit, label, n in units[["unit", "label", "n"]].itertuples(index=False):
        if label == "":
            sizes[unit] = n
        else:
            labels.setdefault(unit, {})[label] = n
    need = {r.label: [shares[s] * r.n for s in names] for r in totals.itertuples(index=False)}
    room = need.get("", [0.0] * len(names))
    holders: dict[str, list] = {}
    for unit, own in labels.items():
        for label, n in own.items():
            holders.setdefault(label, []).append((-n, -sizes[unit], unit))
    for line in holders.values():
        line.sort(reverse=True)  # the heaviest last, to be taken first
    left = {label: -sum(n for n, _, _ in line) for label, line in holders.items()}
    rarest = [(n, label) for label, n in left.items()]
    heapq.heapify(rarest)
    out: dict[str, str] = {}

    def put(unit: str, label: str) -> None:
        wish = need.get(label, room)
        fits = [i for i in range(len(names)) if room[i] >= sizes[unit] * 0.999]
        i = max(fits, key=lambda i: (wish[i], room[i], -i)) if fits else max(range(len(names)), key=lambda i: (room[i], -i))
        out[unit] = names[i]
        room[i] -= sizes[unit]
        for other, n in labels.get(unit, {}).items():
            need[other][i] -= n
            left[other] -= n
            heapq.heappush(rarest, (left[other], other))

    while rarest:
        n, label = heapq.heappop(rarest)
        if n != left[label]:
            continue  # counted anew since
        line = holders[label]
        while line and line[-1][2] in out:
            line.pop()
        if line:
            put(line.pop()[2], label)
    for unit in sorted(sizes.keys() - out.keys(), key=lambda u: (-sizes[u], u)):
        put(unit, "")
    return pd.DataFrame({"unit": list(out), "split": list(out.values())}, dtype="object")


def grouped_split(
    rows: DataFrame,
    record: str,
    group: str,
    labels: list[str],
    shares: dict[str, float],
    seed: int = 0,
    units: int = UNITS,
) -> DataFrame:
    """``record, component, split``, one row for each record (a non-null id).

    Rows that share a ``record`` or a non-null ``group`` belong to one component
    and get one split.  A record without any group is a component of its own.
    ``shares`` gives the wanted share of records of each split, in all and within
    each value of each of ``labels``.

    1. Components: a record ties the groups its rows name; only records of
       several groups make links, so the graph is one of groups.
    2. Label vectors: records counted per component and label value.
    3. Units: components belong to the stratum of their rarest label.  One with
       half of ``1 / units`` of all records or more is a unit of its own; the
       others of a stratum are dealt to bundles of about that size by a seeded
       hash, and their label vectors are summed.
    4. Iterative stratification of all units: the rarest outstanding label
       first, into the split that needs it most and has room.  So every
       component is placed by the same rule, small ones as part of a bundle of
       their like; a call sees no more than a few units a label and ``units``
       more, however many components there are.

    Repeated rows count once.  A record with several values of a label counts
    with the greatest; null labels are a value of their own.  Rows without a
    record are left out.  Empty tables give no rows.  Shares are met as well as
    whole components allow.
    """
    if not shares or abs(sum(shares.values()) - 1) > 1e-9 or min(shares.values()) < 0:
        raise ValueError("shares must be non-negative and sum to one")
    marks = [f"l{i}" for i in range(len(labels))]
    base = rows.select(
        F.col(record).alias("id"),
        F.col(group).cast("string").alias("grp"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("(null)")).alias(m) for c, m in zip(labels, marks)],
    ).filter(F.col("id").isNotNull())
    records = written(
        base.groupBy("id").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), *[F.max(m).alias(m) for m in marks])
    )
    # A record of several groups links each of them to its smallest.
    linked = records.filter("lo <> hi").select("id", "lo")
    edges = (
        base.select("id", "grp").filter(F.col("grp").isNotNull()).join(linked, "id").select(F.col("lo").alias("a"), F.col("grp").alias("b"))
    )
    roots = components(edges)
    keyed = written(
        records.join(roots, F.col("lo") == F.col("node"), "left").select(
            "id",
            F.when(F.col("lo").isNull(), F.concat(F.lit("r:"), F.col("id").cast("string")))
            .otherwise(F.concat(F.lit("g:"), F.coalesce("root", "lo")))
            .alias("component"),
            *marks,
        )
    )
    each = F.array(F.lit(""), *[F.concat(F.lit(f"{c}="), F.col(m)) for c, m in zip(labels, marks)])
    vectors = written(
        keyed.select("component", F.explode(each).alias("label")).groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = vectors.groupBy("label").agg(F.sum("n").alias("n"))
    whole = vectors.filter("label = ''").agg(F.sum("n")).first()[0] or 0
    if totals.count() > MOST_LABELS:
        raise ValueError(f"labels have at most {MOST_LABELS} different values")
    unit_size = max(whole / units, 1.0)
    size = F.max(F.when(F.col("label") == "", F.col("n"))).alias("size")
    rare = F.min_by("label", F.struct(F.col("label") == "", "total", "label")).alias("stratum")
    strata = vectors.join(totals.withColumnRenamed("n", "total"), "label").groupBy("component").agg(size, rare)
    alone = F.col("size") >= unit_size / 2
    bundles = strata.groupBy("stratum").agg(
        F.greatest(
            F.least(F.count_if(~alone), F.lit(UNITS_A_STRATUM)), F.ceil(F.sum(F.when(alone, 0).otherwise(F.col("size"))) / unit_size), F.lit(1)
        ).alias("bundles")
    )
    bundle = F.concat_ws("/", F.lit("b"), F.pmod(F.xxhash64("component", F.lit(seed)), F.col("bundles")).cast("string"), "stratum")
    member = written(strata.join(bundles, "stratum").select("component", F.when(alone, F.concat(F.lit("c/"), "component")).otherwise(bundle).alias("unit")))
    summed = vectors.join(member, "component").groupBy("unit", "label").agg(F.sum("n").alias("n"))
    tagged = summed.unionByName(totals.select(F.lit(None).cast("string").alias("unit"), "label", "n"))

    def place(part: pd.DataFrame) -> pd.DataFrame:
        is_total = part["unit"].isna()
        return _place(part[~is_total], part[is_total], shares)

    # The number of units is bounded by `units` and MOST_LABELS, whatever the size of the table.
    placed = written(tagged.groupBy().applyInPandas(place, "unit string, split string"))
    assigned = member.join(placed, "unit").select("component", "split")
    return keyed.join(assigned, "component").select(F.col("id").alias(record), "component", "split")
