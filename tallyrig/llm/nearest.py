"""Pairing records of two tables by nearest time within a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrig.session import partitions_for

#: Times beyond this are on no clock; nothing is near them.
FAR = 9.0e14


def nearest_by_time(
    left: DataFrame,
    right: DataFrame,
    entity: str,
    left_id: list[str],
    right_id: str,
    tolerance: float,
    left_time: str = "timestamp_ms",
    right_time: str = "timestamp_ms",
    cells: int = 10,
) -> DataFrame:
    """Each left record with the right record of its entity nearest in time.

    Result: ``entity, *left_id, right_id, lag`` (right time minus left time), one row for
    each left record with a right record at most ``tolerance`` away; others are
    left out.  ``right_id`` comes back as ``right_id``.

    Every right time becomes the interval of times it is nearest to, bounded by
    the midpoints to its neighbours and by the tolerance.  Time is divided into
    cells of ``cells`` tolerances; an interval is indexed under each cell it can
    touch, and a left time looks only in its own cell.  A cell holds all right
    records whose tolerance reaches into it, so its intervals are those of the
    whole series there, and no entity needs more than one cell in a task.

    * Among right records of equal time the smallest ``right_id`` counts; of two
      at the same distance the earlier.
    * Null, NaN and infinite times, null entities and null right ids never match.
    * Repeated left records (equal entity and ``left_id``) count once, at their
      smallest usable time.  Other columns are ignored.
    * Empty tables give no rows.
    """
    width = tolerance * cells
    parts = partitions_for(left, right)
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < FAR)
    t, f = F.col("__t"), F.col("__f")

    moments = (
        right.select(F.col(entity), F.col(right_time).cast("double").alias("__t"), F.col(right_id).alias("right_id"))
        .filter(usable(t) & F.col(entity).isNotNull() & F.col("right_id").isNotNull())
        .groupBy(entity, "__t")
        .agg(F.min("right_id").alias("right_id"))
    )
    # One tolerance more than needed keeps rounding at the borders harmless.
    reach = 1.5 * tolerance
    indexed = moments.withColumn(
        "__cell",
        F.explode(F.sequence(F.floor((t - reach) / width), F.floor((t + reach) / width))),
    ).repartition(parts, entity, "__cell")
    by = Window.partitionBy(entity, "__cell").orderBy("__t")
    intervals = (
        indexed.withColumn("__before", F.lag("__t").over(by))
        .withColumn("__after", F.lead("__t").over(by))
        # A hair wider than the midpoints; the exact comparison follows in the join.
        .withColumn("__lo", F.greatest(t - tolerance, (t + F.col("__before")) / 2) - 1e-3 * tolerance)
        .withColumn("__hi", F.least(t + tolerance, (t + F.col("__after")) / 2) + 1e-3 * tolerance)
    )

    records = (
        left.select(F.col(entity), *left_id, F.col(left_time).cast("double").alias("__f"))
        .filter(usable(f) & F.col(entity).isNotNull())
        .groupBy(entity, *left_id)
        .agg(F.min("__f").alias("__f"))
        .withColumn("__cell", F.floor(f / width))
        .repartition(parts, entity, "__cell")
    )
    # With the same subtraction on both sides of each midpoint, exactly one
    # right record holds a left time.
    closer_than_before = F.col("__before").isNull() | (t - f < f - F.col("__before"))
    closer_than_after = F.col("__after").isNull() | (f - t <= F.col("__after") - f)
    paired = records.join(
        intervals,
        (records[entity] == intervals[entity])
        & (records["__cell"] == intervals["__cell"])
        & (f >= F.col("__lo"))
        & (f <= F.col("__hi"))
        & closer_than_before
        & closer_than_after,
        "inner",
    )
    # Times are decimal; without rounding 20 ms could be a hair over 20 ms.
    return paired.filter(F.round(F.abs(t - f), 6) <= tolerance).select(
        records[entity], *[records[c] for c in left_id], "right_id", (t - f).alias("lag")
    )
