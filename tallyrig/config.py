"""Thresholds with defaults, overridden by nested settings."""

from __future__ import annotations

import json
from copy import deepcopy
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits of robots' joints and grippers.
_ARX5 = {
    "joint_low": -3.46, "joint_high": 4.25, "gripper_low": 0.0, "gripper_high": 0.082, "joint_step": 0.15, "gripper_step": 0.015,
    "velocity": 4.5, "acceleration": 50.0, "eef_step": 0.05, "jitter_warn": 0.01, "jitter_fail": 0.05,
}
_WIDE = {
    "joint_low": -6.2832, "joint_high": 6.2832, "gripper_low": 0.0, "gripper_high": 0.10, "joint_step": 0.3, "gripper_step": 0.05,
    "velocity": 2.5, "acceleration": 50.0, "eef_step": 0.05, "jitter_warn": 0.01, "jitter_fail": 0.05,
}
#: Defaults of all checks and planners.
DEFAULTS: dict[str, Any] = {
    "severity_weight": {"critical": 100, "major": 60, "minor": 20, "info": 5, "other": 1},
    "phase2": {"min_duration_s": 5.0, "fps_error": 0.10, "rows_error": 0.10, "outlier_group": 5, "outlier_iqr": 3.0},
    "phase3": {
        "fail_ratio": 0.05, "review_ratio": 0.01, "drop_ratio": 0.10, "tactile_drop_ratio": 0.15, "drop_run_fail": 25, "drop_run_warn": 10,
        "fps_loss": 0.10, "fps_gain": 0.10, "spread_ms": 500, "group": 5, "iqr": 3.0, "gap_warn": 5.0, "gap_fail": 20.0,
    },
    "phase4": {"black": 5.0, "white": 250.0, "frozen": 1.0, "still": 5.0, "still_share": 0.8, "focus": 350.0},
    "phase5": {"tolerance": 0.003, "gripper_mean": 0.005},
    "phase7": {"still": 0.001, "warn_ms": 5000, "review_ms": 10000, "fail_ms": 30000, "edge_ms": 1000, "keep_ms": 500, "least_ms": 5000, "trim_ratio": 0.40},
    "notifications": {
        "statuses": ["fail"], "actionable_statuses": ["needs_review"], "exclude": ["timestamps_raw_inconsistency"],
        "actionable": [
            "abnormal_fps_loss", "frame_drop_ratio", "duration_under_5s", "modality_alignment_start", "modality_alignment_end",
            "standstill_segment", "excessive_standstill", "trajectory_not_smooth", "ik_executability_failed",
        ],
    },
    "motion": {
        "gap_ms": [200, 1000], "number": [1_000_000.0, 1_000_000.0],
        "joint_position_abs": [8.0, 12.0], "joint_position_step": [0.35, 1.0], "joint_velocity_derived": [4.0, 8.0],
        "eef_position_abs": [3.0, 10.0], "eef_position_step": [0.08, 0.25], "eef_velocity_derived": [2.0, 5.0],
    },
    "action": {"xyz_abs": 1.5},
    "streak": {"length": 5, "shown": 20},
    "robots": {"arx5": _ARX5, "flexiv": _WIDE, "aloha": _WIDE},
    "default_robot": "arx5",
}


def merged(defaults: dict, given: dict) -> dict:
    """``defaults`` with ``given`` laid over them, level by level."""
    out = deepcopy(defaults)
    for key, value in given.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load(path: str | None = None, robot: str | None = None) -> dict:
    """The settings of a JSON file over the defaults, and over both what it says of one robot."""
    given = {}
    if path:
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
    out = merged(DEFAULTS, given)
    return merged(out, out["robots"].get(robot, {})) if robot else out


def by_robot(robot: Column, name: str, settings: dict = DEFAULTS) -> Column:
    """A limit for each row's robot; robots without limits have those of the default one."""
    out = F.lit(float(settings["robots"][settings["default_robot"]][name]))
    for key, limits in settings["robots"].items():
        out = F.when(robot == key, float(limits[name])).otherwise(out)
    return out


def robots_sql(settings: dict = DEFAULTS) -> str:
    """The robots' limits as a SQL table, with a row named '' for all others."""
    robots = settings["robots"] | {"": settings["robots"][settings["default_robot"]]}
    names = list(robots[""])
    lines = ", ".join(f"('{key}', " + ", ".join(f"{float(limits[n])}::DOUBLE" for n in names) + ")" for key, limits in robots.items())
    return f"limits(robot, {', '.join(names)}) AS (VALUES {lines})"


def lookup(settings: dict, path: str, default: Any = None) -> Any:
    """A value by dotted path."""
    for part in path.split("."):
        if not isinstance(settings, dict) or part not in settings:
            return default
        settings = settings[part]
    return settings
