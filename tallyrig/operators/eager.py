"""Aggregates over joins without building the join (eager aggregation).

Both inputs are reduced to one compact state per join key and group before they
meet; counts multiply and sums scale by the other side's count.  However many
rows a key has, what is joined is one row per key and group, so a key that holds
most rows delays nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    group: list[str],
    left_sums: list[str] = (),
    right_sums: list[str] = (),
    how: str = "inner",
) -> DataFrame:
    """``count(*)`` and sums per group over ``left JOIN right USING (on)``.

    ``group`` names columns of ``left`` (``on`` columns included).  Result:
    ``group, n_rows, n_left, n_right`` with the rows of the join, its left rows,
    and the right rows that meet the group (a right row counts once in each group
    that has left rows of its key), then ``sum_<column>`` for each summed column, as SQL would give them over the joined rows.  ``how`` is
    ``inner`` or ``left``; with ``left`` an unmatched left row counts as one
    joined row whose right columns are null.  Null keys match nothing, as in
    SQL.  Null values are left out of sums; a sum without values is null.
    Repeated rows count as often as they occur.  Empty inputs give no rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    left_keys = list(dict.fromkeys([*on, *group]))
    a = left.groupBy(*left_keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__l_{c}") for c in left_sums]
    )
    b = right.groupBy(*on).agg(
        F.count(F.lit(1)).alias("__m"), *[F.sum(c).alias(f"__r_{c}") for c in right_sums]
    )
    joined = a.join(b, on, how)
    times = F.coalesce("__m", F.lit(1)).cast("long")
    return joined.groupBy(*group).agg(
        F.sum(F.col("__n") * times).alias("n_rows"),
        F.sum("__n").alias("n_left"),
        F.sum(F.coalesce("__m", F.lit(0))).alias("n_right"),
        *[F.sum(F.col(f"__l_{c}") * times).alias(f"sum_{c}") for c in left_sums],
        *[F.sum(F.col(f"__r_{c}") * F.col("__n")).alias(f"sum_{c}") for c in right_sums],
    )
