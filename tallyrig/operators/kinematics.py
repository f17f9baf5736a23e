"""Reachability of poses for robot arms given by their joint axes; solvers are pluggable.

Arms are small tables of joints (Denavit-Hartenberg rows and limits).  Forward
kinematics and damped-least-squares solving run in numpy over Arrow batches.
Each solve may start from the one before, which makes it sequential within a
chunk of a trajectory; chunks run in parallel and start cold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Arm:
    """A chain of turning joints: rows of (a, alpha, d, theta0), limits and speed limits."""

    name: str
    links: tuple[tuple[float, float, float, float], ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    speed: tuple[float, ...]


def frames(arm: Arm, q: np.ndarray) -> list[np.ndarray]:
    """The frame after each joint, from the base's on."""
    out = [np.eye(4)]
    for (a, alpha, d, theta0), angle in zip(arm.links, q):
        t = theta0 + angle
        c, s, ca, sa = np.cos(t), np.sin(t), np.cos(alpha), np.sin(alpha)
        link = np.array([[c, -s * ca, s * sa, a * c], [s, c * ca, -c * sa, a * s], [0, sa, ca, d], [0, 0, 0, 1]])
        out.append(out[-1] @ link)
    return out


def position(arm: Arm, q: np.ndarray) -> np.ndarray:
    return frames(arm, q)[-1][:3, 3]


def jacobian(arm: Arm, q: np.ndarray) -> np.ndarray:
    """How the hand's position moves with each joint."""
    chain = frames(arm, q)
    tip = chain[-1][:3, 3]
    return np.stack([np.cross(t[:3, 2], tip - t[:3, 3]) for t in chain[:-1]], axis=1)


def solve_position(
    arm: Arm, target: np.ndarray, start: np.ndarray, steps: int = 80, damping: float = 0.05, tolerance: float = 1e-4, restarts: int = 8
) -> tuple[np.ndarray, float]:
    """Joint angles that bring the hand to ``target``, and the distance left.

    Damped least squares from ``start``; where that stalls, again from seeded
    random configurations.
    """
    low, high = np.array(arm.low), np.array(arm.high)
    best, left = start.copy(), np.inf
    random = np.random.default_rng(0)
    for attempt in range(restarts + 1):
        found, gap = _descend(arm, target, start if attempt == 0 else random.uniform(low, high), steps, damping, tolerance)
        if gap < left:
            best, left = found, gap
        if left < tolerance:
            break
    return best, left


def _descend(arm: Arm, target: np.ndarray, start: np.ndarray, steps: int, damping: float, tolerance: float) -> tuple[np.ndarray, float]:
    """Damped least squares steps from one start; the best configuration on the way."""
    q, low, high = start.copy(), np.array(arm.low), np.array(arm.high)
    best, left = q.copy(), np.inf
    for _ in range(steps):
        gap = target - position(arm, q)
        size = float(np.linalg.norm(gap))
        if size < left:
            best, left = q.copy(), size
        if size < tolerance:
            break
        j = jacobian(arm, q)
        q = np.clip(q + j.T @ np.linalg.solve(j @ j.T + damping**2 * np.eye(3), gap), low, high)
    return best, left


Solver = Callable[[Arm, np.ndarray, np.ndarray], tuple[np.ndarray, float]]


def evaluate_points(
    poses: DataFrame, arm: Arm, axes: list[str], chunk_rows: int = 2048, tolerance: float = 0.005, solver: Solver = solve_position
) -> DataFrame:
    """Whether each point can be reached: ``episode_path, row_idx, error_m, manipulability, margin, speed_ratio, reachable, reason, quality``.

    Five tests: position error, joint limits' margin, manipulability, speed from
    the row before within the chunk, and finite input.  ``quality`` is the least
    of their ratios cut to 0..1, ``reason`` the first test that fails.
    """
    schema = (
        "episode_path string, row_idx long, error_m double, manipulability double, margin double, speed_ratio double,"
        " reachable boolean, reason string, quality double"
    )
    low, high, speed = (np.array(x) for x in (arm.low, arm.high, arm.speed))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row_idx")
        q = (low + high) / 2
        before, when, out = None, None, []
        for row in part[["episode_path", "row_idx", "timestamp_ms", *axes]].itertuples(index=False, name=None):
            target = np.array(row[3:], float)
            if not np.isfinite(target).all():
                out.append((*row[:2], None, None, None, None, False, "not_finite", 0.0))
                continue
            q, error = solver(arm, target, q)
            j = jacobian(arm, q)
            measure = float(np.sqrt(max(0.0, np.linalg.det(j @ j.T))))
            margin = float(np.min(np.minimum(q - low, high - q) / (high - low)))
            dt = (row[2] - when) / 1000 if when is not None and row[2] is not None else None
            rate = float(np.max(np.abs(q - before) / dt / speed)) if dt is not None and dt > 0 else 0.0
            before, when = q, row[2]
            ratios = [
                ("position_error", 1 - error / tolerance),
                ("joint_limit", margin / 0.02),
                ("singular", measure / 1e-3),
                ("too_fast", 2 - rate),
            ]
            reason = next((n for n, r in ratios if r <= 0 or (n in ("joint_limit", "singular") and r < 1) or (n == "too_fast" and r < 1)), "")
            quality = float(min(np.clip(r, 0, 1) for _, r in ratios))
            out.append((*row[:2], error, measure, margin, rate, reason == "", reason, quality))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    usable = poses.select("episode_path", "row_idx", "timestamp_ms", *axes).filter("episode_path IS NOT NULL AND row_idx IS NOT NULL")
    chunked = usable.withColumn("__c", F.floor(F.col("row_idx") / chunk_rows))
    return chunked.groupBy("episode_path", "__c").applyInPandas(lambda part: run(part), schema)


def workspace(spark: SparkSession, arm: Arm, samples: int = 10_000, seed: int = 0, batch: int = 1_000) -> DataFrame:
    """Seeded random configurations and where they put the hand: ``i, x, y, z``."""
    low, high = np.array(arm.low), np.array(arm.high)

    def place(parts):
        for part in parts:
            points = []
            for i in part["id"]:
                q = np.random.default_rng((seed, int(i))).uniform(low, high)
                points.append((int(i), *position(arm, q)))
            yield pd.DataFrame(points, columns=["i", "x", "y", "z"])

    return spark.range(0, samples, numPartitions=max(1, samples // batch)).mapInPandas(place, "i long, x double, y double, z double")


def workspace_bounds(points: DataFrame) -> DataFrame:
    """Percentile bounds of a sampled workspace: ``axis, low, high``."""
    axes = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("v")) for a in "xyz"])
    return points.select(F.inline(axes)).groupBy("axis").agg(
        F.expr("percentile(v, 0.01)").alias("low"), F.expr("percentile(v, 0.99)").alias("high")
    )


def best_offset(points: DataFrame, bounds: DataFrame, reach: float = 0.3, per_axis: int = 5) -> DataFrame:
    """The offset on a grid that brings most points into the bounds: ``dx, dy, dz, inside``.

    Candidates are a fixed grid of ``per_axis`` cubed, counted in one pass.
    """
    box = {r["axis"]: (r["low"], r["high"]) for r in bounds.collect()}  # three rows
    steps = [reach * (2 * k / (per_axis - 1) - 1) for k in range(per_axis)]
    grid = [(x, y, z) for x in steps for y in steps for z in steps]
    inside = [
        F.count_if(
            F.col("x").between(box["x"][0] - a, box["x"][1] - a)
            & F.col("y").between(box["y"][0] - b, box["y"][1] - b)
            & F.col("z").between(box["z"][0] - c, box["z"][1] - c)
        )
        for a, b, c in grid
    ]
    rows = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("dz"), n.alias("inside")) for (a, b, c), n in zip(grid, inside)])
    counted = points.agg(rows.alias("r")).select(F.inline("r"))
    far = F.abs("dx") + F.abs("dy") + F.abs("dz")
    return counted.orderBy(F.desc("inside"), far, "dx", "dy", "dz").limit(1)
