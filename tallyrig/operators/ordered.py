"""Looking along long series: previous rows, running counts, islands, near windows.

A series is cut into chunks of its order column, so that none of its keys needs
one task for all rows; what crosses a chunk border is one summary a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyrig.session import partitions_for

CHUNK_ROWS = 8192


def one_row_each(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Each (keys, order) once, with the smallest values; rows without keys or order are left out."""
    there = F.lit(True)
    for c in (*keys, order):
        there = there & F.col(c).isNotNull()
    return df.filter(there).groupBy(*keys, order).agg(*[F.min(v).alias(v) for v in values])


def _chunked(df: DataFrame, keys: list[str], order: str, chunk_rows: int) -> DataFrame:
    return df.withColumn("__c", F.floor(F.col(order) / chunk_rows)).repartition(partitions_for(df), *keys, "__c")


def with_previous(
    df: DataFrame, keys: list[str], order: str, columns: list[str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``prev_<column>``, the value one row earlier in the series (null in its first row).

    ``keys`` and ``order`` are not null and name each row once.  Each chunk's
    last row is found by an aggregate, and only those rows meet in one line.
    """
    base = _chunked(df, keys, order, chunk_rows)
    by = Window.partitionBy(*keys, "__c").orderBy(order)
    line = Window.partitionBy(*keys).orderBy("__c")
    last = F.max_by(F.struct(*[F.col(c).alias(f"__b_{c}") for c in columns]), order)
    tails = base.groupBy(*keys, "__c").agg(last.alias("__t")).withColumn("__t", F.lag("__t").over(line)).select(*keys, "__c", "__t.*")
    seen = base.select("*", F.row_number().over(by).alias("__k"), *[F.lag(c).over(by).alias(f"prev_{c}") for c in columns])
    seen = seen.join(tails, [*keys, "__c"])
    first = F.col("__k") == 1
    return seen.select(*df.columns, *[F.when(first, F.col(f"__b_{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}") for c in columns])


def with_last_known(df: DataFrame, keys: list[str], order: str, columns: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``prev_<column>``, the last value before each row that is not null.

    Columns are looked up each for itself, so one sort serves all of them.
    """
    base = _chunked(df, keys, order, chunk_rows)
    by = Window.partitionBy(*keys, "__c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    line = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    ends = base.groupBy(*keys, "__c").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__e_{c}") for c in columns])
    ends = ends.select(*keys, "__c", *[F.last(f"__e_{c}", True).over(line).alias(f"__b_{c}") for c in columns])
    inside = base.select("*", *[F.last(c, True).over(by).alias(f"__p_{c}") for c in columns]).join(ends, [*keys, "__c"])
    return inside.select(*df.columns, *[F.coalesce(f"__p_{c}", f"__b_{c}").alias(f"prev_{c}") for c in columns])


def running_sum(
    df: DataFrame, keys: list[str], order: str, value: Column, name: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds the sum of ``value`` over the series up to and including each row."""
    base = _chunked(df.withColumn("__x", value), keys, order, chunk_rows)
    before = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        base.groupBy(*keys, "__c")
        .agg(F.sum("__x").alias("__t"))
        .withColumn("__o", F.coalesce(F.sum("__t").over(before), F.lit(0)))
        .drop("__t")
    )
    by = Window.partitionBy(*keys, "__c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = base.withColumn(name, F.sum("__x").over(by))
    return (
        inside.join(offsets, [*keys, "__c"])
        .withColumn(name, F.col(name) + F.col("__o"))
        .drop("__c", "__x", "__o")
    )


def islands(df: DataFrame, keys: list[str], order: str, opens: Column, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Adds ``island``: a number that rises by one at each row where ``opens`` holds."""
    return running_sum(df, keys, order, F.when(opens, 1).otherwise(0), "island", chunk_rows)


def over_rows(
    df: DataFrame, keys: list[str], order: str, make: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int, after: int, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """What ``make`` adds over windows of at most ``before`` rows back and ``after`` rows on.

    ``make`` is given rows and an ordered window over them.  It runs within each
    chunk, and once more over the first and last ``before + after`` rows of all
    chunks of a series; rows near a chunk's ends are taken from the second run.
    Rows are counted, so it does not matter which values of ``order`` exist or
    how few rows a chunk has.
    """
    whole = Window.partitionBy(*keys, "__c")
    by, reach = whole.orderBy(order), before + after
    base = _chunked(df, keys, order, chunk_rows)
    base = base.withColumn("__k", F.row_number().over(by)).withColumn("__n", F.count(F.lit(1)).over(whole))
    k, from_end = F.col("__k"), F.col("__n") - F.col("__k")
    edge = (k <= before) | (from_end < after)
    inner = make(base, by).filter(~edge)
    rim = base.filter((k <= reach) | (from_end < reach))
    rim = make(rim, Window.partitionBy(*keys).orderBy(order)).filter(edge)
    return inner.unionByName(rim).drop("__c", "__k", "__n")


def with_halo(df: DataFrame, keys: list[str], order: str, halo: float, chunk: float = CHUNK_ROWS) -> DataFrame:
    """Rows in chunks with what lies near them: adds ``__c`` and ``__native``.

    Rows whose ``order`` lies within ``halo`` of a chunk's border also go to the
    chunk beyond it.  A *range* window over ``keys + __c`` that reaches no further
    than ``halo`` is exact for native rows; for windows that count rows use
    ``over_rows``.  ``halo`` must not exceed ``chunk``.
    """
    if halo > chunk:
        raise ValueError("a halo must not be longer than a chunk")
    here = F.floor(F.col(order) / chunk)
    spread = F.array_distinct(
        F.array(here, F.floor((F.col(order) - halo) / chunk), F.floor((F.col(order) + halo) / chunk))
    )
    out = df.withColumn("__c", F.explode(spread)).withColumn("__native", F.col("__c") == here)
    return out.repartition(partitions_for(df), *keys, "__c")
