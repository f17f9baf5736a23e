"""Exact order statistics and ranks of groups of any size without gathering a group.

A histogram over logarithmic buckets, combined on the map side, tells in which
buckets the wanted ranks lie; only the values of those buckets are then counted
and ranked, each bucket by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets for each doubling of the value; a bucket is 0.27 % wide.
BUCKETS_PER_OCTAVE = 256


def _bucket(value: Column) -> Column:
    """A bucket number that never falls as the value rises."""
    size = F.floor(F.log2(F.abs(value)) * BUCKETS_PER_OCTAVE).cast("int") + 2**20  # positive for every double
    size = F.when(F.abs(value) == float("inf"), F.lit(2**30)).otherwise(size)
    return F.when(value == 0, 0).when(value > 0, size).otherwise(-size)


def _counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``__k`` (the keys), ``__b`` (bucket), ``__v`` and its count ``__c``; null and NaN are left out.

    The keys form one struct, in which nulls are equal.
    """
    v = F.col("__v")
    values = df.select(F.struct(*keys).alias("__k"), F.col(value).cast("double").alias("__v")).filter(v.isNotNull() & ~F.isnan(v))
    return values.withColumn("__b", _bucket(v))


def _offsets(values: DataFrame) -> DataFrame:
    """``__k, __b``, how many values lie in lower buckets (``__before``) and how many in all (``__n``)."""
    counts = values.groupBy("__k", "__b").agg(F.count(F.lit(1)).alias("__c"))
    group = Window.partitionBy("__k")
    upto = group.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("__k", "__b", "__c", (F.sum("__c").over(upto) - F.col("__c")).alias("__before"), F.sum("__c").over(group).alias("__n"))


def grouped_ranks(df: DataFrame, keys: list[str], value: str, ranks: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Order statistics per group: ``keys, n`` and one column for each wanted rank.

    ``ranks`` gives, for a column with the number of a group's values, the
    wanted places in ascending order, counted from zero, by name; places outside
    the group give null.  Null and NaN values are ignored; a group without
    values has no row; ties count as often as they occur; null keys are equal.
    """
    values = _counted(df, keys, value)
    wanted = ranks(F.col("__n"))
    hit = F.lit(False)
    for place in wanted.values():
        hit = hit | ((place >= F.col("__before")) & (place < F.col("__before") + F.col("__c")))
    places = F.struct(*[place.cast("long").alias(name) for name, place in wanted.items()])
    picked = _offsets(values).filter(hit).select("__k", "__b", "__before", "__n", places.alias("__at"))
    distinct = values.groupBy("__k", "__b", "__v").agg(F.count(F.lit(1)).alias("__c"))
    within = Window.partitionBy("__k", "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("__before") + F.sum("__c").over(within)
    ranked = distinct.join(picked, ["__k", "__b"]).withColumn("__upto", upto)

    def at(name: str) -> Column:
        place = F.col(f"__at.{name}")
        return F.max(F.when((place < F.col("__upto")) & (place >= F.col("__upto") - F.col("__c")), F.col("__v"))).alias(name)

    out = ranked.groupBy("__k").agg(F.max("__n").alias("n"), *[at(name) for name in wanted])
    return out.select(*[F.col("__k")[c].alias(c) for c in keys], "n", *wanted)


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles per group: ``keys, n`` and a column for each name.

    A quantile lies at ``q * (n - 1)`` among the sorted values, between two of
    them linearly.  Otherwise as ``grouped_ranks``.
    """
    place = lambda q, n: F.lit(float(q)) * (n - 1)
    ends = lambda n: {
        f"__{i}{end}": cut(place(q, n)) for i, q in enumerate(quantiles.values()) for end, cut in (("lo", F.floor), ("hi", F.ceil))
    }
    out = grouped_ranks(df, keys, value, ends)

    def between(i: int, q: float) -> Column:
        lo, hi, at = F.col(f"__{i}lo"), F.col(f"__{i}hi"), place(q, F.col("n"))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at)))

    return out.select(*keys, "n", *[between(i, q).alias(name) for i, (name, q) in enumerate(quantiles.items())])


def grouped_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Midpoint median per group: ``keys + [name]``; otherwise as ``grouped_ranks``."""
    middle = lambda n: {"__a": F.floor((n - 1) / 2), "__z": F.floor(n / 2)}
    a, z = F.col("__a"), F.col("__z")
    return grouped_ranks(df, keys, value, middle).select(*keys, F.when(a == z, a).otherwise((a + z) / 2).alias(name))


def average_ranks(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the rank of ``value`` within its group, counted from one; ties share their mean rank.

    Null and NaN values have a null rank.
    """
    values = _counted(df, keys, value)
    distinct = values.groupBy("__k", "__b", "__v").agg(F.count(F.lit(1)).alias("__m"))
    within = Window.partitionBy("__k", "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.col("__before") + F.sum("__m").over(within) - (F.col("__m") - 1) / 2
    ranked = distinct.join(_offsets(values), ["__k", "__b"]).select("__k", F.col("__v").alias("__x"), rank.alias(name))
    tagged = df.withColumn("__k", F.struct(*keys)).withColumn("__x", F.col(value).cast("double"))
    return tagged.join(ranked, ["__k", "__x"], "left").select(*df.columns, name)
