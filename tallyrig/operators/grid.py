"""Irregular readings onto a regular grid of time slots.

Each reading holds from its time to the next one (a step function); the
intervals are cut at slot borders and summed into time-weighted means, coverage
and reading counts.  A source is cut into long stretches of time, each with the
readings up to the longest bridged silence on both sides, so that no source
needs more than one stretch in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrig.session import partitions_for

#: Times beyond this are not on any recording's clock.
FAR_MS = 9.0e14


def regular_grid(
    readings: DataFrame,
    keys: list[str],
    time: str = "timestamp_ms",
    value: str | None = None,
    slot_ms: int = 100,
    max_gap_ms: int = 30_000,
    hold_ms: int | None = None,
    stretch_slots: int = 6_000,
) -> DataFrame:
    """One row per source and slot, from each source's readings.

    Result: ``keys, slot, n_readings, coverage, mean_value, missing``.  ``slot``
    is ``floor(time / slot_ms)``.  A slot between two successive readings that
    holds none is ``missing`` if they are at most ``max_gap_ms`` apart; a longer
    silence is a pause and has no rows.  A reading is valid up to the next one,
    for ``hold_ms`` (by default one slot) at most: ``coverage`` is the valid
    share of the slot, ``mean_value`` the mean weighted by valid time, null
    without valid time or without ``value``.

    Null, NaN and infinite times are skipped.  Readings of one source at one
    time count once, with their mean value.  Null keys form a source of their
    own.  Empty tables give no rows.
    """
    hold = slot_ms if hold_ms is None else hold_ms
    stretch = slot_ms * stretch_slots
    if max_gap_ms > stretch:
        raise ValueError("a stretch must be longer than the longest bridged silence")
    t = F.col("__t")
    taken = readings.select(
        *keys,
        F.col(time).cast("double").alias("__t"),
        (F.col(value).cast("double") if value else F.lit(None).cast("double")).alias("__v"),
    ).filter(t.isNotNull() & ~F.isnan("__t") & (F.abs(t) <= FAR_MS))
    single = taken.groupBy(*keys, "__t").agg(F.avg("__v").alias("__v")) if value else taken.groupBy(*keys, "__t").agg(
        F.first("__v").alias("__v")
    )
    here = F.floor(t / stretch)
    spread = single.withColumn(
        "__c",
        F.explode(
            F.array_distinct(
                F.array(here, F.floor((t - max_gap_ms) / stretch), F.floor((t + max_gap_ms) / stretch))
            )
        ),
    )
    part = [*keys, "__c"]
    by = Window.partitionBy(*part).orderBy("__t")
    first_slot, last_slot = F.col("__c") * stretch_slots, (F.col("__c") + 1) * stretch_slots - 1
    held = (
        spread.repartition(partitions_for(readings), *part)
        .withColumn("__next", F.lead("__t").over(by))
        .withColumn("__next", F.when(F.col("__next") - t <= max_gap_ms, F.col("__next")))
        .withColumn("__s", F.floor(t / slot_ms))
        .withColumn("__e", F.coalesce(F.floor(F.col("__next") / slot_ms), F.col("__s")))
        .withColumn("__until", F.least(F.coalesce("__next", F.lit(float("inf"))), t + hold))
        .withColumn("__from", F.greatest("__s", first_slot))
        .withColumn("__to", F.least("__e", last_slot))
        .filter(F.col("__from") <= F.col("__to"))
        .withColumn("slot", F.explode(F.sequence("__from", "__to")))
    )
    valid = F.greatest(
        F.lit(0.0),
        F.least(F.col("__until"), (F.col("slot") + 1) * slot_ms) - F.greatest(t, F.col("slot") * slot_ms),
    )
    held = held.withColumn("__w", valid)
    # The last slot of an interval belongs to the next reading, which starts in it.
    sums = held.groupBy(*part, "slot").agg(
        F.sum(F.when(F.col("slot") == F.col("__s"), 1).otherwise(0)).alias("n_readings"),
        F.sum("__w").alias("__valid"),
        F.sum(F.when(F.col("__v").isNotNull(), F.col("__w"))).alias("__known"),
        F.sum(F.col("__w") * F.col("__v")).alias("__area"),
    )
    return sums.select(
        *keys,
        "slot",
        "n_readings",
        (F.col("__valid") / slot_ms).alias("coverage"),
        F.when(F.col("__known") > 0, F.col("__area") / F.col("__known")).alias("mean_value"),
        (F.col("n_readings") == 0).alias("missing"),
    )
