"""Phase 5: findings about joints, grippers and hands, by the limits of each episode's robot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.config import DEFAULTS, by_robot, robots_sql
from tallyrig.functions import exprs as X
from tallyrig.operators.ordered import CHUNK_ROWS, over_rows, with_last_known
from tallyrig.operators.quantile import grouped_quantiles
from tallyrig.plans.base import SQL, clean_episodes
from tallyrig.plans.registry import Registry
from tallyrig.plans.series import JOINTS, each_joint, joints, path_and_steps

R = Registry()
COLUMNS = [*JOINTS, "gripper"]
_T, _MEAN = DEFAULTS["phase5"]["tolerance"], DEFAULTS["phase5"]["gripper_mean"]


def finding(check: str, severity: Column | str, status: Column | str, hit: Column, subject: Column | None = None, measured: Column | None = None) -> Column:
    """A finding where ``hit`` holds, else null."""
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    of = F.lit(None) if subject is None else subject
    value = F.lit(None) if measured is None else F.round(measured, 5)
    return F.when(
        F.coalesce(hit, F.lit(False)),
        F.struct(
            F.lit(check).alias("check_name"), text(severity).alias("severity"), text(status).alias("status"),
            of.cast("string").alias("subject"), value.cast("double").alias("measured"),
        ),
    )


def emitted(rows: DataFrame, keys: list[str], findings: list[Column]) -> DataFrame:
    """``keys, check_name, severity, status, subject, measured`` of all findings, from one pass over ``rows``."""
    return rows.select(*keys, F.inline(F.array_compact(F.array(*findings))))


def share_tiers(ratio: Column) -> tuple[Column, Column]:
    """Severity and status of a share of violating rows."""
    p = DEFAULTS["phase3"]
    severity = F.when(ratio >= p["review_ratio"], "major").otherwise("minor")
    return severity, F.when(ratio >= p["fail_ratio"], "fail").when(ratio >= p["review_ratio"], "needs_review").otherwise("warning")


def speeds(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``episode_path, joint, kind, v``: sizes of speeds and accelerations between finite readings whose time rises."""
    key = ["episode_path"]
    timed = rows.filter(X.finite(F.col("timestamp_ms")))
    t = F.col("timestamp_ms") / 1000.0
    readings = [F.when(X.finite(F.col(j)), F.struct(t.alias("t"), F.col(j).alias("x"))).alias(j) for j in JOINTS]
    pairs = with_last_known(timed.select(*key, "row_idx", *readings), key, "row_idx", JOINTS, chunk_rows)

    def speed(j: str) -> Column:
        dt = F.col(f"{j}.t") - F.col(f"prev_{j}.t")
        return F.when(dt > 0, F.struct(((F.col(f"{j}.x") - F.col(f"prev_{j}.x")) / dt).alias("v"), dt.alias("dt"))).alias(j)

    moved = with_last_known(pairs.select(*key, "row_idx", *[speed(j) for j in JOINTS]), key, "row_idx", JOINTS, chunk_rows)
    made = []
    for j in JOINTS:
        v, before = F.col(f"{j}.v"), F.col(f"prev_{j}.v")
        made += [
            F.struct(F.lit(j).alias("joint"), F.lit("velocity").alias("kind"), F.abs(v).alias("v")),
            F.struct(F.lit(j).alias("joint"), F.lit("acceleration").alias("kind"), F.abs((v - before) / F.col(f"{j}.dt")).alias("v")),
        ]
    return moved.select(*key, F.inline(F.array(*made))).filter("v IS NOT NULL")


_WIDE_SQL = (
    SQL.rstrip()
    + ", " + robots_sql() + ", s AS (SELECT episode_path, row_idx, min(timestamp_ms) AS t, " + ", ".join(f"min({c}) AS {c}" for c in COLUMNS)
    + """ FROM state_joint_position GROUP BY ALL),
r AS (SELECT e.episode_path, ep.robot AS named, l.* EXCLUDE (robot) FROM (SELECT DISTINCT episode_path FROM s) e LEFT JOIN ep USING (episode_path)
  JOIN limits l ON l.robot = CASE WHEN ep.robot IN (SELECT robot FROM limits) THEN ep.robot ELSE '' END),
u AS (SELECT * FROM s UNPIVOT INCLUDE NULLS (x FOR col IN (""" + ", ".join(COLUMNS) + """))),
b AS (SELECT episode_path, col, count(*) AS bad FROM u WHERE x IS NULL OR NOT isfinite(x) GROUP BY 1, 2),
f AS (SELECT *, abs(x - lag(x) OVER w) AS step, x - avg(x) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS off FROM u WHERE isfinite(x) WINDOW w AS (PARTITION BY episode_path, col ORDER BY row_idx)),
g AS (SELECT episode_path, col, max(step) AS step, avg(x) AS mean, min(x) AS low, max(x) AS high, avg(abs(off)) AS jitter FROM f GROUP BY 1, 2),
t0 AS (SELECT episode_path, t, lag(t) OVER (PARTITION BY episode_path ORDER BY row_idx) AS p FROM s WHERE isfinite(t)),
ts AS (SELECT episode_path, count(*) AS n, count(*) FILTER (WHERE t <= p) / count(*) AS ratio FROM t0 GROUP BY 1),
v0 AS (SELECT episode_path, col, row_idx, (t - lag(t) OVER w) / 1000.0 AS dt, x - lag(x) OVER w AS dx FROM u WHERE isfinite(x) AND isfinite(t) AND col <> 'gripper' WINDOW w AS (PARTITION BY episode_path, col ORDER BY row_idx)),
v1 AS (SELECT *, dx / dt AS v FROM v0 WHERE dt > 0), v2 AS (SELECT *, abs((v - lag(v) OVER (PARTITION BY episode_path, col ORDER BY row_idx)) / dt) AS a FROM v1),
q AS (SELECT episode_path, col, quantile_cont(abs(v), 0.99) AS v, quantile_cont(a, 0.99) AS a FROM v2 GROUP BY 1, 2)
"""
)
_TIERS = "CASE WHEN ratio >= 0.01 THEN 'major' ELSE 'minor' END, CASE WHEN ratio >= 0.05 THEN 'fail' WHEN ratio >= 0.01 THEN 'needs_review' ELSE 'warning' END"
_HANDS_SQL = (
    "h AS (SELECT episode_path, row_idx, "
    + ", ".join(f"min({s}_{a}) AS {s}_{a}" for s in ("left", "right") for a in "xyz")
    + " FROM actions_eef_pose GROUP BY ALL), hs AS ("
    + " UNION ALL ".join(f"SELECT episode_path, row_idx, '{s}' AS col, {s}_x AS x, {s}_y AS y, {s}_z AS z FROM h" for s in ("left", "right"))
    + "), hd AS (SELECT *, sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2) + power(z - lag(z) OVER w, 2)) AS d FROM hs"
    " WHERE isfinite(x) AND isfinite(y) AND isfinite(z) AND abs(x) < 1e6 WINDOW w AS (PARTITION BY episode_path, col ORDER BY row_idx)),"
    " hm AS (SELECT hd.episode_path, col, max(d) AS d, any_value(eef_step) AS lim FROM hd LEFT JOIN ep USING (episode_path)"
    " JOIN limits l ON l.robot = CASE WHEN ep.robot IN (SELECT robot FROM limits) THEN ep.robot ELSE '' END GROUP BY 1, 2)"
)


@R.add(
    _WIDE_SQL
    + f""", {_HANDS_SQL}
SELECT episode_path, 'robot_config_fallback' AS check_name, 'info' AS severity, 'pass' AS status, named AS subject, NULL::DOUBLE AS measured FROM r WHERE coalesce(named, '') NOT IN (SELECT robot FROM limits WHERE robot <> '')
UNION ALL SELECT episode_path, 'joint_nan_inf', 'critical', 'fail', col, bad FROM b
UNION ALL SELECT episode_path, 'timestamps_missing_or_unparseable', 'major', 'fail', NULL, NULL FROM r WHERE episode_path NOT IN (SELECT episode_path FROM ts)
UNION ALL SELECT episode_path, 'timestamps_not_monotonic', {_TIERS}, NULL, round(ratio, 5) FROM ts WHERE ratio > 0
UNION ALL SELECT episode_path, 'joint_out_of_limits', 'minor', 'needs_review', col, round(greatest(joint_low - low, high - joint_high), 5) FROM g JOIN r USING (episode_path) WHERE col <> 'gripper' AND (low < joint_low - {_T} OR high > joint_high + {_T})
UNION ALL SELECT episode_path, 'gripper_out_of_limits', 'minor', 'needs_review', col, round(greatest(gripper_low - low, high - gripper_high), 5) FROM g JOIN r USING (episode_path) WHERE col = 'gripper' AND (low < gripper_low - {_T} OR high > gripper_high + {_T})
UNION ALL SELECT episode_path, 'gripper_mean_too_low_remap_needed', 'minor', 'needs_review', col, round(mean, 5) FROM g WHERE col = 'gripper' AND mean < {_MEAN}
UNION ALL SELECT episode_path, 'joint_step_too_large', 'minor', 'needs_review', col, round(step, 5) FROM g JOIN r USING (episode_path) WHERE col <> 'gripper' AND step > joint_step
UNION ALL SELECT episode_path, 'gripper_step_too_large', 'minor', 'needs_review', col, round(step, 5) FROM g JOIN r USING (episode_path) WHERE col = 'gripper' AND step > gripper_step
UNION ALL SELECT episode_path, 'joint_velocity_exceeded', 'minor', 'needs_review', col, round(v, 5) FROM q JOIN r USING (episode_path) WHERE v > velocity
UNION ALL SELECT episode_path, 'joint_acceleration_high', 'minor', 'warning', col, round(a, 5) FROM q JOIN r USING (episode_path) WHERE a > acceleration
UNION ALL SELECT episode_path, 'jitter_high', CASE WHEN jitter >= jitter_fail THEN 'major' ELSE 'minor' END, CASE WHEN jitter >= jitter_fail THEN 'fail' ELSE 'warning' END, col, round(jitter, 5) FROM g JOIN r USING (episode_path) WHERE col <> 'gripper' AND jitter >= jitter_warn
UNION ALL SELECT episode_path, 'eef_position_step_too_large', 'minor', 'needs_review', col, round(d, 5) FROM hm WHERE d > lim"""
)
def check_phase5(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Findings of the robot-state checks: ``episode_path, check_name, severity, status, subject, measured``.

    Every joint, the gripper and both hands are judged; ``subject`` names them.
    A step is between readings of a column that follow one another, whatever
    null, NaN and infinite ones lie between.
    """
    key = ["episode_path"]
    rows = joints(spark, sf_dir)
    robots = clean_episodes(spark, sf_dir).select("episode_path", "robot")
    robot = F.col("robot")
    limit = lambda name: by_robot(robot, name)

    time = F.when(X.finite(F.col("timestamp_ms")), F.col("timestamp_ms")).alias("t")
    known = [F.when(X.finite(F.col(c)), F.col(c)).alias(c) for c in COLUMNS]
    pairs = with_last_known(rows.select(*key, "row_idx", time, *known), key, "row_idx", ["t", *COLUMNS], chunk_rows)
    each = pairs.groupBy(*key).agg(
        F.count("t").alias("times"),
        (F.count_if(F.col("t") <= F.col("prev_t")) / F.count("t")).alias("back"),
        *[F.count_if(F.col(c).isNull()).alias(f"bad_{c}") for c in COLUMNS],
        *[F.max(F.abs(F.col(c) - F.col(f"prev_{c}"))).alias(f"step_{c}") for c in COLUMNS],
        *[F.min(c).alias(f"low_{c}") for c in COLUMNS],
        *[F.max(c).alias(f"high_{c}") for c in COLUMNS],
        F.avg("gripper").alias("mean"),
    )
    back = F.col("back")
    severity, status = share_tiers(back)
    found = [
        finding("robot_config_fallback", "info", "pass", F.coalesce(~robot.isin(*DEFAULTS["robots"]), F.lit(True)), robot),
        finding("timestamps_missing_or_unparseable", "major", "fail", F.col("times") == 0),
        finding("timestamps_not_monotonic", severity, status, back > 0, None, back),
        finding("gripper_mean_too_low_remap_needed", "minor", "needs_review", F.col("mean") < _MEAN, F.lit("gripper"), F.col("mean")),
    ]
    for c in COLUMNS:
        kind, name = ("gripper" if c == "gripper" else "joint"), F.lit(c)
        low, high, step = F.col(f"low_{c}"), F.col(f"high_{c}"), F.col(f"step_{c}")
        least, most = limit(f"{kind}_low"), limit(f"{kind}_high")
        found += [
            finding("joint_nan_inf", "critical", "fail", F.col(f"bad_{c}") > 0, name, F.col(f"bad_{c}")),
            finding(f"{kind}_out_of_limits", "minor", "needs_review", (low < least - _T) | (high > most + _T), name, F.greatest(least - low, high - most)),
            finding(f"{kind}_step_too_large", "minor", "needs_review", step > limit(f"{kind}_step"), name, step),
        ]
    whole = emitted(each.join(robots, key, "left"), key, found)

    fast = grouped_quantiles(speeds(rows, chunk_rows), ["episode_path", "joint", "kind"], "v", {"p99": 0.99}).join(robots, key, "left")
    name, p99, kind = F.col("joint"), F.col("p99"), F.col("kind")
    moves = emitted(fast, key, [
        finding("joint_velocity_exceeded", "minor", "needs_review", (kind == "velocity") & (p99 > limit("velocity")), name, p99),
        finding("joint_acceleration_high", "minor", "warning", (kind == "acceleration") & (p99 > limit("acceleration")), name, p99),
    ])

    def off(df: DataFrame, by) -> DataFrame:
        return df.withColumn("d", F.abs(F.col("v") - F.avg("v").over(by.rowsBetween(-2, 2))))

    shaken = over_rows(each_joint(rows), ["episode_path", "joint"], "row_idx", off, 2, 2, chunk_rows).groupBy("episode_path", "joint").agg(F.avg("d").alias("j"))
    j = F.col("j")
    bad = j >= limit("jitter_fail")
    jitter = finding("jitter_high", F.when(bad, "major").otherwise("minor"), F.when(bad, "fail").otherwise("warning"), j >= limit("jitter_warn"), name, j)
    shakes = emitted(shaken.join(robots, key, "left"), key, [jitter])

    steps = path_and_steps(spark, sf_dir, chunk_rows).join(robots, key, "left")
    far = F.col("largest_step")
    hands = emitted(steps, key, [finding("eef_position_step_too_large", "minor", "needs_review", far > limit("eef_step"), F.col("side"), far)])
    return whole.unionByName(moves).unionByName(shakes).unionByName(hands)


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
