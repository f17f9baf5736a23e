"""Trajectory labels, repair plans and interpolation over masked rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrig.functions import exprs as X
from tallyrig.operators.ordered import islands, with_halo, with_previous

SIDES = ("left", "right")
CELL_MS = 10_000


def jump_events(
    poses: DataFrame, jump_m: float = 0.35, window_ms: int = 500, recover_ms: int = 1000, merge_ms: int = 500, chunk_ms: int = 600_000
) -> DataFrame:
    """Fast moves of either hand: ``episode_path, side, start_ms, end_ms, first_ms, last_ms, peak_m, recovered``.

    A row is fast if it is more than ``jump_m`` from the earliest row of the last
    ``window_ms``.  Fast rows less than ``merge_ms`` apart form one event.  It is
    recovered if after its peak the hand is again within ``jump_m`` of where it
    was before, within ``recover_ms`` of the start.  Times count from the first
    row.  Rows with a value that is missing or not finite are left out; of rows
    at one millisecond the first counts.
    """
    axes = [f"{s}_{a}" for s in SIDES for a in "xyz"]
    good = X.finite(F.col("timestamp_ms")) & F.col("episode_path").isNotNull()
    for c in axes:
        good = good & X.finite(F.col(c))
    rows = poses.filter(good).groupBy("episode_path", F.round("timestamp_ms").cast("long").alias("ms")).agg(
        F.min_by(F.struct(*axes), "row_idx").alias("p")
    )
    bounds = rows.groupBy("episode_path").agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), *[F.col(f"p.{s}_{a}").alias(a) for a in "xyz"]) for s in SIDES])
    line = rows.select("episode_path", "ms", F.inline(sides))
    key = ["episode_path", "side"]

    def apart(a: str, b: str):
        return F.sqrt(sum((F.pow(F.col(f"{a}.{c}") - F.col(f"{b}.{c}"), 2) for c in "xyz"), F.lit(0.0)))

    paired = with_previous(line.select(*key, "ms", F.struct("x", "y", "z").alias("p")), key, "ms", ["p"], chunk_ms)
    near = with_halo(paired, key, "ms", halo=window_ms, chunk=chunk_ms)
    by = Window.partitionBy(*key, "__c").orderBy("ms").rangeBetween(-window_ms, 0)
    moved = near.withColumn("then", F.first("p").over(by)).filter("__native")
    fast = moved.filter(apart("p", "then") > jump_m).select(*key, "ms", F.coalesce("prev_p", "p").alias("before"))
    gaps = with_previous(fast, key, "ms", ["ms"], chunk_ms)
    runs = (
        islands(gaps, key, "ms", F.coalesce(F.col("ms") - F.col("prev_ms") >= merge_ms, F.lit(True)), chunk_ms)
        .groupBy(*key, "island")
        .agg(F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"), F.min_by("before", "ms").alias("anchor"))
    )
    # Each event meets the rows of the cells of time it reaches into.
    spread = runs.withColumn(
        "cell",
        F.explode(
            F.sequence(F.floor(F.col("start_ms") / CELL_MS), F.floor(F.greatest(F.col("end_ms"), F.col("start_ms") + recover_ms) / CELL_MS))
        ),
    )
    cells = line.select(*key, "ms", F.struct("x", "y", "z").alias("p"), F.floor(F.col("ms") / CELL_MS).alias("cell"))
    met = cells.join(spread, [*key, "cell"]).filter(
        (F.col("ms") >= F.col("start_ms")) & (F.col("ms") <= F.greatest(F.col("end_ms"), F.col("start_ms") + recover_ms))
    )
    met = met.withColumn("d", apart("p", "anchor"))
    inside = F.when(F.col("ms") <= F.col("end_ms"), F.col("ms"))
    back = F.when((F.col("d") <= jump_m) & (F.col("ms") - F.col("start_ms") <= recover_ms), F.col("ms"))
    events = met.groupBy(*key, "start_ms", "end_ms").agg(
        F.max(F.when(inside.isNotNull(), F.struct("d", (-F.col("ms")).alias("m")))).alias("peak"), F.max(back).alias("back")
    )
    return events.join(bounds, "episode_path").select(
        *key, "start_ms", "end_ms", "first_ms", "last_ms", F.col("peak.d").alias("peak_m"),
        F.coalesce(F.col("back") > -F.col("peak.m"), F.lit(False)).alias("recovered"),
    )


def trajectory_labels(poses: DataFrame, edge_ms: int = 3000, chunk_ms: int = 600_000) -> DataFrame:
    """One of five labels an episode, and what to do with it.

    ``smooth``, ``recoverable``, ``middle_smooth``, ``middle_recoverable`` or
    ``unrecoverable``; the worse hand decides.  ``action`` is passthrough,
    interpolate, interpolate_crop or reject.  Episodes of fewer than two usable
    moments have no label.
    """
    events = jump_events(poses, chunk_ms=chunk_ms)
    start, end = F.col("start_ms") - F.col("first_ms"), F.col("end_ms") - F.col("first_ms")
    edge = (start <= edge_ms) | (end >= F.col("last_ms") - F.col("first_ms") - edge_ms)
    lost = ~F.col("recovered")
    any_of = lambda c: F.bool_or(c)
    found = events.groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("events"),
        any_of(lost).alias("lost"),
        any_of(lost & (~edge | (end - start >= edge_ms))).alias("beyond"),
        any_of(~lost & ~edge).alias("middle"),
    )
    usable = X.finite(F.col("timestamp_ms"))
    for s in SIDES:
        for a in "xyz":
            usable = usable & X.finite(F.col(f"{s}_{a}"))
    moments = poses.filter(usable).select("episode_path", F.round("timestamp_ms").alias("ms")).distinct()
    there = moments.groupBy("episode_path").agg(F.count(F.lit(1)).alias("moments"))
    label = (
        F.when(F.col("events").isNull(), "smooth")
        .when(F.col("beyond"), "unrecoverable")
        .when(~F.col("lost"), "recoverable")
        .when(F.col("middle"), "middle_recoverable")
        .otherwise("middle_smooth")
    )
    action = (
        F.when(F.col("label") == "smooth", "passthrough")
        .when(F.col("label") == "recoverable", "interpolate")
        .when(F.col("label") == "unrecoverable", "reject")
        .otherwise("interpolate_crop")
    )
    return there.filter("moments >= 2 AND episode_path IS NOT NULL").join(found, "episode_path", "left").select(
        "episode_path", "moments", F.coalesce("events", F.lit(0)).alias("events"), label.alias("label")
    ).withColumn("action", action)


def pchip(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Monotone cubic interpolation (Fritsch and Carlson) through (x, y); held beyond the ends."""
    n = len(x)
    if n == 0:
        return np.full(len(at), np.nan)
    if n == 1:
        return np.full(len(at), y[0])
    h = np.diff(x)
    slope = np.diff(y) / h
    d = np.empty(n)
    if n == 2:
        d[:] = slope[0]
    else:
        w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = (w1 + w2) / (w1 / slope[:-1] + w2 / slope[1:])
        d[1:-1] = np.where(slope[:-1] * slope[1:] > 0, mean, 0.0)
        for end, (h0, h1, s0, s1) in ((0, (h[0], h[1], slope[0], slope[1])), (-1, (h[-1], h[-2], slope[-1], slope[-2]))):
            e = ((2 * h0 + h1) * s0 - h0 * s1) / (h0 + h1)
            if np.sign(e) != np.sign(s0):
                e = 0.0
            elif np.sign(s0) != np.sign(s1) and abs(e) > 3 * abs(s0):
                e = 3 * s0
            d[end] = e
    t = np.clip(at, x[0], x[-1])
    k = np.clip(np.searchsorted(x, t, side="right") - 1, 0, n - 2)
    u = (t - x[k]) / h[k]
    return (
        y[k] * (1 + 2 * u) * (1 - u) ** 2 + h[k] * d[k] * u * (1 - u) ** 2
        + y[k + 1] * u**2 * (3 - 2 * u) + h[k] * d[k + 1] * u**2 * (u - 1)
    )


def repair_masked(
    rows: DataFrame, keys: list[str], order: str, values: list[str], bad: str, chunk_rows: int = 8192
) -> DataFrame:
    """Replaces ``values`` in rows marked ``bad`` by interpolation through the good rows.

    Works in chunks; each also gets, of each value, the two nearest good rows
    before and after it, however far away.  The cubic between two good rows
    depends on no more than those, so chunks do not change the result.  A null
    mark counts as bad; before the first and after the last good row its value
    holds; a series without good rows gets NaN.
    """
    at, part = F.col(order).cast("double"), [*keys, "__c"]
    base = rows.select(*keys, order, *[F.col(v).cast("double").alias(v) for v in values], bad)
    base = base.withColumn("__c", F.floor(F.col(order) / chunk_rows)).repartition(*part)
    good = lambda v: F.when(~F.coalesce(F.col(bad), F.lit(True)) & X.finite(F.col(v)), F.struct(at.alias("o"), F.col(v).alias("v")))
    # A chunk's rows bound these lists.
    ends = base.groupBy(*part).agg(*[F.sort_array(F.collect_list(good(v))).alias(f"g{i}") for i, v in enumerate(values)])
    for side, direction in (("b", F.asc), ("a", F.desc)):
        line = Window.partitionBy(*keys).orderBy(direction("__c")).rowsBetween(Window.unboundedPreceding, -1)
        near = lambda i, k: F.try_element_at(f"g{i}", F.lit(-k if side == "b" else k))  # noqa: B023,E731
        every = range(len(values))
        # The nearest good row beyond the chunk; then with it the one behind, which may lie in a chunk further on.
        ends = ends.select("*", *[F.last(near(i, 1), True).over(line).alias(f"n{i}") for i in every])
        pairs = [F.when(near(i, 1).isNotNull(), F.struct(near(i, 1).alias("p"), F.coalesce(near(i, 2), F.col(f"n{i}")).alias("q"))) for i in every]
        ends = ends.select("*", *[F.last(pair, True).over(line).alias(f"{side}{i}") for i, pair in zip(every, pairs)]).drop(*[f"n{i}" for i in every])
    marks = [F.col(f"{side}{i}.{k}.{c}").alias(f"{side}{i}{k}{c}") for i in range(len(values)) for side in "ba" for k in "pq" for c in "ov"]
    context = ends.select(*part, *marks)
    columns = [*keys, order, *values, bad]

    def fill(here: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
        here = here.sort_values(order)
        x, mask = here[order].to_numpy(float), here[bad].fillna(True).to_numpy(bool)
        known = beyond.iloc[0]
        for i, v in enumerate(values):
            y = here[v].to_numpy(float)
            take = ~mask & np.isfinite(y)
            outer = [(known[f"{s}{i}{k}o"], known[f"{s}{i}{k}v"]) for s, k in ("bq", "bp", "ap", "aq")]
            outer = [np.array([p for p in two if not pd.isna(p[0])], dtype=float).reshape(-1, 2) for two in (outer[:2], outer[2:])]
            gx = np.concatenate([outer[0][:, 0], x[take], outer[1][:, 0]])
            gy = np.concatenate([outer[0][:, 1], y[take], outer[1][:, 1]])
            here[v] = np.where(mask, pchip(gx, gy, x), y)
        return here[columns]

    return base.groupBy(*part).cogroup(context.groupBy(*part)).applyInPandas(fill, base.select(*columns).schema)
