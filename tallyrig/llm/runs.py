"""Collapsing runs of near-identical consecutive events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrig.session import partitions_for

#: Rows of recording order in one chunk.
CHUNK_ROWS = 8192


def collapse_runs(
    rows: DataFrame,
    entity: str,
    order: str,
    states: list[str],
    within: float,
    time: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row for each longest stretch of rows that stay near the row before.

    Result: ``entity, first_<order>, last_<order>, n_rows, start_time,
    end_time, duration``.  A row continues a run if each of ``states`` differs
    from the row before by less than ``within``.

    Runs are associative summaries: (first row, last row, their states, count,
    time range).  Each chunk of ``chunk_rows`` in recording order encodes its
    runs by itself; the first and the last run of each chunk then merge with
    their neighbours in one prefix pass over at most two summaries a chunk.
    Inner runs are final where they are.  An entity may hold any share of rows.

    * A null or NaN state is near to nothing, so its row is a run of its own.
    * Repeated rows (equal entity and order) count once, with the smallest
      values.  Rows without entity or order are left out.
    * Times that are null or NaN are skipped in ``start_time`` (the earliest),
      ``end_time`` (the latest) and ``duration``, which are null if none is left.
    * Empty tables give no rows.
    """
    n = len(states)
    clock = F.col(time).cast("double") if time else F.lit(None).cast("double")
    # All columns get names of their own, so that entity, order and states may have any.
    taken = rows.select(
        F.col(entity).alias("e"),
        F.col(order).alias("o"),
        clock.alias("t"),
        *[F.col(c).cast("double").alias(f"s{i}") for i, c in enumerate(states)],
    ).filter(F.col("e").isNotNull() & F.col("o").isNotNull())
    single = taken.groupBy("e", "o").agg(
        F.min(F.when(~F.isnan("t"), F.col("t"))).alias("t"), *[F.min(f"s{i}").alias(f"s{i}") for i in range(n)]
    )
    chunked = single.withColumn("c", F.floor(F.col("o") / chunk_rows)).repartition(partitions_for(rows), "e", "c")
    part = Window.partitionBy("e", "c")
    by = part.orderBy("o")
    near = F.lit(True)
    for i in range(n):
        near = near & (F.abs(F.col(f"s{i}") - F.lag(f"s{i}").over(by)) < within)
    opened = chunked.withColumn("new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    opened = opened.withColumn("first", F.lag("o").over(by).isNull()).withColumn("last", F.lead("o").over(by).isNull())
    # Only the chunk's first and last states can meet a neighbour.
    ends = [F.max(F.when(F.col("first"), F.col(f"s{i}"))).alias(f"h{i}") for i in range(n)]
    ends += [F.max(F.when(F.col("last"), F.col(f"s{i}"))).alias(f"l{i}") for i in range(n)]
    local = (
        opened.withColumn("r", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("e", "c", "r")
        .agg(
            F.min("o").alias("lo"),
            F.max("o").alias("hi"),
            F.count(F.lit(1)).alias("n"),
            F.min("t").alias("t0"),
            F.max("t").alias("t1"),
            F.max("first").alias("first"),
            F.max("last").alias("last"),
            *ends,
        )
    )
    plain = ["e", "lo", "hi", "n", "t0", "t1"]
    inner = local.filter(~F.col("first") & ~F.col("last")).select(*plain)

    rim = local.filter(F.col("first") | F.col("last"))
    line = Window.partitionBy("e").orderBy("lo")
    joins = F.col("first")
    for i in range(n):
        joins = joins & (F.abs(F.col(f"h{i}") - F.lag(f"l{i}").over(line)) < within)
    joins = F.coalesce(joins, F.lit(False))
    merged = (
        rim.withColumn("new", F.when(joins, 0).otherwise(1))
        .withColumn("g", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("e", "g")
        .agg(
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sum("n").alias("n"),
            F.min("t0").alias("t0"),
            F.max("t1").alias("t1"),
        )
        .select(*plain)
    )
    return inner.unionByName(merged).select(
        F.col("e").alias(entity),
        F.col("lo").alias(f"first_{order}"),
        F.col("hi").alias(f"last_{order}"),
        F.col("n").alias("n_rows"),
        F.col("t0").alias("start_time"),
        F.col("t1").alias("end_time"),
        (F.col("t1") - F.col("t0")).alias("duration"),
    )
