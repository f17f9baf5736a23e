"""Percentiles of very large groups by distributed multi-select."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrig.session import written

#: The end of the recursion: a range of so few values is ranked directly.
FINISH_ROWS = 256


def percentiles(
    df: DataFrame,
    group: list[str],
    value: str,
    quantiles: list[float],
    weight: str | None = None,
    finish_rows: int = FINISH_ROWS,
) -> DataFrame:
    """Exact percentiles per group: ``group, quantile, n, value``.

    A percentile lies at ``quantile * (n - 1)`` among the sorted values, between
    two of them linearly.  With ``weight`` each row stands for that many values.

    Rounds until every wanted rank is found: within each range that still holds
    wanted ranks, each partition proposes its local median; the weighted median
    of the proposals becomes the pivot; values below, at and above it are
    counted; ranks at the pivot are found, the others go on in the lower or
    upper range, and values of ranges without ranks are discarded.  The rounds
    end when no range has more than ``finish_rows`` values, a constant that does
    not depend on the data; those few are ranked directly.  A value is joined to its
    pivot by group, range and the partition it came from, so no group gathers
    in a task, and only two numbers a round reach the driver.

    Null, NaN and infinite values and weights below one are skipped; a group
    without values has no row.  Null group keys form a group.  Empty input gives
    no rows.
    """
    if not quantiles or any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError("quantiles must lie between 0 and 1")
    keys = [f"g{i}" for i in range(len(group))]
    # Null keys must meet in equi-joins, so keys are compared null-safely through a tag.
    tag = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})
    v, w = F.col("v"), F.col("w")
    start = df.select(
        *[F.col(c).alias(k) for c, k in zip(group, keys)],
        F.col(value).cast("double").alias("v"),
        (F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("w"),
    ).filter(v.isNotNull() & ~F.isnan("v") & (F.abs(v) < float("inf")) & (w >= 1))
    start = start.withColumn("g", tag).withColumn("salt", F.spark_partition_id()).withColumn("r", F.lit(1).cast("long"))
    base = written(start.select("g", *keys, "salt", "r", "v", "w"))

    sizes = written(base.groupBy("g", *keys).agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("rows")))
    wanted = (
        sizes.select("g", "n", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q"))
        .withColumn("pos", F.col("q") * (F.col("n") - 1))
        .select("g", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("target"))
        .distinct()
    )
    targets = written(wanted.select("g", F.lit(1).cast("long").alias("r"), F.col("target").alias("k"), "target"))
    active = base.select("g", "salt", "r", "v", "w")
    found: list[DataFrame] = []
    most = sizes.agg(F.max("rows")).first()[0] or 0

    while most > finish_rows:
        spot = Window.partitionBy("g", "r")
        order = spot.orderBy("m", "salt").rowsBetween(Window.unboundedPreceding, 0)
        proposals = active.groupBy("g", "r", "salt").agg(
            F.percentile_approx("v", 0.5, 200).alias("m"), F.sum("w").alias("c")
        )
        pivots = written(
            proposals.withColumn("cum", F.sum("c").over(order))
            .withColumn("all", F.sum("c").over(spot))
            .withColumn("p", F.min(F.when(F.col("cum") * 2 >= F.col("all"), F.col("m"))).over(spot))
            .select("g", "r", "salt", "p")
        )
        p = F.col("p")
        counted = (
            active.join(pivots, ["g", "r", "salt"])
            .groupBy("g", "r")
            .agg(
                F.max("p").alias("p"),
                F.sum(F.when(v < p, w).otherwise(0)).alias("below"),
                F.sum(F.when(v == p, w).otherwise(0)).alias("at"),
                F.count_if(v < p).alias("rows_below"),
                F.count_if(v > p).alias("rows_above"),
            )
        )
        judged = written(targets.join(counted, ["g", "r"]))
        hit = (F.col("k") >= F.col("below")) & (F.col("k") < F.col("below") + F.col("at"))
        lower = F.col("k") < F.col("below")
        found.append(judged.filter(hit).select("g", "target", p.alias("v")))
        targets = judged.filter(~hit).select(
            "g",
            (F.col("r") * 2 + F.when(lower, 0).otherwise(1)).alias("r"),
            F.when(lower, F.col("k")).otherwise(F.col("k") - F.col("below") - F.col("at")).alias("k"),
            "target",
        )
        sides = judged.groupBy("g", "r").agg(F.bool_or(lower).alias("low"), F.bool_or(~hit & ~lower).alias("high"))
        keep = pivots.join(sides, ["g", "r"])
        active = written(
            active.join(keep, ["g", "r", "salt"])
            .filter(((v < p) & F.col("low")) | ((v > p) & F.col("high")))
            .select("g", "salt", (F.col("r") * 2 + F.when(v < p, 0).otherwise(1)).alias("r"), "v", "w")
        )
        left = judged.filter(~hit).agg(
            F.max(F.when(lower, F.col("rows_below")).otherwise(F.col("rows_above")))
        )
        most = left.first()[0] or 0

    # Ranges are small now: rank within each.
    upto = Window.partitionBy("g", "r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        active.groupBy("g", "r", "v")
        .agg(F.sum("w").alias("w"))
        .withColumn("cum", F.sum("w").over(upto))
    )
    last = targets.join(ranked, ["g", "r"]).filter((F.col("k") < F.col("cum")) & (F.col("k") >= F.col("cum") - w))
    out = last.select("g", "target", "v")
    for part in found:
        out = out.unionByName(part)
    out = written(out)

    lines = sizes.withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles]))).withColumn(
        "pos", F.col("quantile") * (F.col("n") - 1)
    )
    low = out.select("g", F.col("target").alias("lo"), F.col("v").alias("vlo"))
    high = out.select("g", F.col("target").alias("hi"), F.col("v").alias("vhi"))
    joined = (
        lines.withColumn("lo", F.floor("pos"))
        .withColumn("hi", F.ceil("pos"))
        .join(low, ["g", "lo"])
        .join(high, ["g", "hi"])
    )
    between = F.col("vlo") + (F.col("vhi") - F.col("vlo")) * (F.col("pos") - F.col("lo"))
    return joined.select(
        *[F.col(k).alias(c) for c, k in zip(group, keys)],
        "quantile",
        "n",
        F.when(F.col("vlo") == F.col("vhi"), F.col("vlo")).otherwise(between).alias("value"),
    )


def _bucket(value: Column, error: float) -> Column:
    base = math.log((1 + error) / (1 - error))
    size = F.ceil(F.ln(F.abs(value)) / base)
    return F.struct(F.signum(value).cast("int").alias("sign"), F.when(value != 0, size).otherwise(0).alias("size"))


def summarise(df: DataFrame, group: list[str], value: str, error: float = 0.005) -> DataFrame:
    """Counts of values per group in buckets of relative width: ``group, sign, size, n``.

    Summaries of separate days or partitions combine by adding ``n`` (or by a
    plain union).  Each value is within ``error`` of its bucket's value, so any
    percentile of combined summaries is within ``error`` of the exact one,
    relative to it.  Null, NaN and infinite values are skipped.
    """
    taken = df.select(*group, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v") & (F.abs("__v") < float("inf"))
    )
    bucketed = taken.withColumn("__b", _bucket(F.col("__v"), error))
    return (
        bucketed.select(*group, "__b.sign", "__b.size")
        .groupBy(*group, "sign", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def combined_percentiles(
    summaries: DataFrame, group: list[str], quantiles: list[float], error: float = 0.005, **options
) -> DataFrame:
    """Percentiles per group over any union of summaries: ``group, quantile, n, value, max_relative_error``.

    The same multi-select, over bucket values weighted by their counts.
    """
    base = (1 + error) / (1 - error)
    middle = F.col("sign") * F.pow(F.lit(base), F.col("size")) * F.lit(1 - error)
    merged = summaries.groupBy(*group, "sign", "size").agg(F.sum("n").alias("__n")).withColumn("__value", middle)
    out = percentiles(merged, group, "__value", quantiles, weight="__n", **options)
    return out.withColumn("max_relative_error", F.lit(error))
