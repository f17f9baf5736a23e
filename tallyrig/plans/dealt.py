"""The core queries p1_, p3_ and p4_ over the episode tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.functions.text import is_fresh, tidy_name
from tallyrig.operators.eager import join_aggregate
from tallyrig.operators.grid import regular_grid
from tallyrig.operators.spikes import SpikeRule, implausible_readings
from tallyrig.session import table

POSE, JOINT = "actions.eef_pose", "observation.state.joint_position"
#: Fixed values of TESTDATA.md, problem 1.  A pose is compared with the five readings before and the five after it;
#: a time with the readings around it, so that the last one before a silence and the first one after it are no cases.
POSE_RULE = SpikeRule(factor=10, held_rows=8, low=-2.0, high=2.0, own=False)
TIME_RULE = SpikeRule(factor=20, held_rows=4, low=0.0, high=float("inf"))
RULES = {f"{POSE}|left_x": POSE_RULE, f"{POSE}|right_z": POSE_RULE, f"{JOINT}|timestamp_ms": TIME_RULE}

#: The place of rows without a row_idx.
LAST_ROW = 2**63 - 1


def p1_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings problem 1 watches, as ``source, field, row_idx, value``.

    Rows without a ``row_idx`` are one reading after all others, as in the SQL.
    The last of a source is no case, but moves where the last five begin.
    """
    place = F.coalesce("row_idx", F.lit(LAST_ROW)).alias("row_idx")
    pose = table(spark, sf_dir, "actions_eef_pose").select(
        F.col("episode_path").alias("source"),
        place,
        F.expr(f"stack(2, '{POSE}|left_x', left_x, '{POSE}|right_z', right_z) as (field, value)"),
    )
    joint = table(spark, sf_dir, "state_joint_position").select(
        F.col("episode_path").alias("source"),
        place,
        F.lit(f"{JOINT}|timestamp_ms").alias("field"),
        F.col("timestamp_ms").alias("value"),
    )
    return pose.unionByName(joint)


def p1_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implausible readings with the reasons."""
    return implausible_readings(p1_readings(spark, sf_dir), RULES).select(
        F.substring_index("field", "|", 1).alias("stream"),
        F.substring_index("field", "|", -1).alias("field"),
        F.col("source").alias("episode_path"),
        "row_idx",
        "spike",
        "held",
        "impossible",
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_flags(spark, sf_dir).select("stream", "field", "episode_path", "row_idx")


def latest_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current version of each episode, with tidied task and robot.

    The latest ``last_updated`` counts (null the earliest).  Versions of one
    time are settled by the largest remaining values, so copies fall together.
    """
    episodes = table(spark, sf_dir, "episodes")
    columns = ["task", "robot", "operator", "date", "final_status", "training_ready", "metrics"]
    newest = episodes.groupBy("episode_path").agg(
        F.max(F.struct("last_updated", *columns)).alias("__e")
    )
    return newest.select("episode_path", "__e.*").select(
        "episode_path",
        tidy_name(F.col("task")).alias("task"),
        tidy_name(F.col("robot")).alias("robot"),
        *columns[2:],
    )


def _p3(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Per ``key``: episodes, findings, flagged share and recorded time.

    Findings are reduced to one state an episode before they meet the episodes,
    so neither a key nor an episode with most of the rows delays the rest.
    A finding counts once however often its id is repeated.
    """
    episodes = latest_episodes(spark, sf_dir).select(
        "episode_path",
        F.coalesce(key, F.lit("(unknown)")).alias(key),
        F.expr("try_cast(get_json_object(metrics, '$.p2_duration_seconds') as double)").alias("__d"),
    )
    # Text such as nan, and values out of all proportion (over a day), are no durations.
    good = F.col("__d").isNotNull() & ~F.isnan("__d") & (F.col("__d") > 0) & (F.col("__d") <= 86400)
    # Whole milliseconds, so that sums do not depend on the order of rows.
    duration = F.when(good, F.round(F.col("__d") * 1000).cast("long"))
    episodes = episodes.select("episode_path", key, duration.alias("duration"))
    episodes = episodes.withColumn("timed", F.col("duration").isNotNull().cast("int"))
    findings = (
        table(spark, sf_dir, "findings")
        .groupBy("id")
        .agg(F.min("episode_path").alias("episode_path"), F.max("status").alias("status"))
        .groupBy("episode_path")
        .agg(
            F.count(F.lit(1)).alias("finding_count"),
            F.count_if(F.col("status") != "pass").alias("flagged_count"),
            F.max((F.col("status") != "pass").cast("int")).alias("flagged"),
        )
    )
    out = join_aggregate(
        episodes,
        findings,
        on=["episode_path"],
        group=[key],
        left_sums=["duration", "timed"],
        right_sums=["finding_count", "flagged_count", "flagged"],
        how="left",
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        key,
        F.col("n_left").alias("episodes"),
        zero("sum_finding_count").alias("findings"),
        zero("sum_flagged_count").alias("flagged_findings"),
        zero("sum_flagged").alias("flagged_episodes"),
        F.round(zero("sum_flagged") / F.col("n_left"), 6).alias("flagged_share"),
        F.round(F.col("sum_duration") / 1000, 3).alias("duration_seconds"),
        F.round(F.col("sum_duration") / F.nullif(F.col("sum_timed"), F.lit(0)) / 1000, 6).alias("mean_duration"),
    )


def p3_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir, "task")


def p3_by_robot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir, "robot")


def p3_task_robot_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames and episodes per task and robot; one episode may hold most frames."""
    episodes = latest_episodes(spark, sf_dir).select(
        "episode_path",
        F.coalesce("task", F.lit("(unknown)")).alias("task"),
        F.coalesce("robot", F.lit("(unknown)")).alias("robot"),
    )
    frames = table(spark, sf_dir, "frame_times").select(
        "episode_path", is_fresh(F.col("is_new"), F.col("timestamp_ms")).cast("int").alias("fresh")
    )
    out = join_aggregate(
        episodes, frames, ["episode_path"], ["task", "robot"], right_sums=["fresh"], how="inner"
    )
    return out.select(
        "task",
        "robot",
        F.col("n_left").alias("episodes"),
        F.col("n_rows").alias("frame_rows"),
        F.col("sum_fresh").alias("fresh_rows"),
    )


def p3_task_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode versions times trim plans of the same task: counts of a many-to-many join."""
    left = table(spark, sf_dir, "episodes").select(tidy_name(F.col("task")).alias("task"))
    right = table(spark, sf_dir, "trim_plan").select(
        tidy_name(F.col("task")).alias("task"), F.col("removed_total_ms").alias("removed_ms")
    )
    out = join_aggregate(left, right, ["task"], ["task"], right_sums=["removed_ms"])
    return out.select(
        "task",
        F.col("n_rows").alias("pairs"),
        F.round("sum_removed_ms", 3).alias("removed_ms"),
    )


def p4_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable times of all streams of problem 4."""
    frames = table(spark, sf_dir, "frame_times")
    frames = frames.filter(is_fresh(F.col("is_new"), F.col("timestamp_ms"))).select(
        "episode_path", "modality", "timestamp_ms", F.lit(None).cast("double").alias("value")
    )
    plan = (
        table(spark, sf_dir, "trim_plan")
        .groupBy("episode_path")
        .agg(F.min("first_timestamp_ms").alias("__first"), F.max("last_timestamp_ms").alias("__last"))
    )
    joints = table(spark, sf_dir, "state_joint_position").select("episode_path", "timestamp_ms", "j1")
    joints = (
        joints.filter(F.col("timestamp_ms").isNotNull() & ~F.isnan("timestamp_ms"))
        .join(plan, "episode_path")
        .filter(F.col("timestamp_ms").between(F.col("__first"), F.col("__last")))
        .select("episode_path", F.lit(JOINT).alias("modality"), "timestamp_ms", F.col("j1").alias("value"))
    )
    return frames.unionByName(joints)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = regular_grid(p4_readings(spark, sf_dir), ["episode_path", "modality"])
    return grid.filter("missing").select("episode_path", "modality", "slot")


def p4_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole series: counts, coverage and the time-weighted mean of j1 in each slot."""
    grid = regular_grid(p4_readings(spark, sf_dir), ["episode_path", "modality"], value="value")
    return grid.select(
        "episode_path",
        "modality",
        "slot",
        "n_readings",
        F.round("coverage", 6).alias("coverage"),
        F.round("mean_value", 6).alias("mean_value"),
        "missing",
    )


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            p1_found,
            p1_flags,
            p3_by_task,
            p3_by_robot,
            p3_task_robot_frames,
            p3_task_pairs,
            p4_found,
            p4_grid,
        )
    }


_P1 = """
SELECT stream, field, episode_path, row_idx{flags} FROM (
WITH r AS (
  SELECT 'actions.eef_pose' AS stream, 'left_x' AS field, episode_path, row_idx, min(left_x) AS v,
         10 AS k, 8 AS h, -2.0 AS lo, 2.0 AS hi
  FROM actions_eef_pose WHERE left_x IS NOT NULL AND NOT isnan(left_x) GROUP BY ALL
  UNION ALL
  SELECT 'actions.eef_pose', 'right_z', episode_path, row_idx, min(right_z), 10, 8, -2.0, 2.0
  FROM actions_eef_pose WHERE right_z IS NOT NULL AND NOT isnan(right_z) GROUP BY ALL
  UNION ALL
  SELECT 'observation.state.joint_position', 'timestamp_ms', episode_path, row_idx, min(timestamp_ms), 20, 4, 0.0,
         'infinity'::DOUBLE
  FROM state_joint_position WHERE timestamp_ms IS NOT NULL AND NOT isnan(timestamp_ms) GROUP BY ALL
), o AS (
  SELECT *, lag(v) OVER w AS prev, row_number() OVER w AS rn,
         count(*) OVER (PARTITION BY stream, field, episode_path) AS n,
         list(v) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS five, list(v) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS next_five
  FROM r WINDOW w AS (PARTITION BY stream, field, episode_path ORDER BY row_idx)
), e AS (
  SELECT *, CASE WHEN abs(v) < 'infinity' OR abs(prev) < 'infinity' THEN abs(v - prev) END AS d,
         sum(CASE WHEN v = prev THEN 0 ELSE 1 END) OVER (PARTITION BY stream, field, episode_path ORDER BY row_idx) AS run
  FROM o
), s AS (SELECT stream, field, episode_path, median(d) AS step FROM e GROUP BY ALL),
l AS (
  SELECT *, count(*) OVER (PARTITION BY stream, field, episode_path, run) AS held_for,
         list_median(CASE WHEN field = 'timestamp_ms' THEN list_concat(five, [v], next_five) ELSE list_concat(five, next_five) END) AS level
  FROM e
)
SELECT l.*,
       CASE WHEN isnan(v - level) THEN false ELSE coalesce(abs(v - level) > k * step, false) END AS spike,
       coalesce(v = prev, false) AND held_for >= h AS held,
       v < lo OR v > hi OR isinf(v) AS impossible
FROM l JOIN s USING (stream, field, episode_path)
WHERE rn > 5 AND rn <= n - 5
) WHERE spike OR held OR impossible
"""

_LATEST = r"""
latest AS (
  SELECT episode_path, CAST(e.task AS VARCHAR) AS raw_task, CAST(e.robot AS VARCHAR) AS raw_robot, e.metrics AS metrics FROM (
    SELECT episode_path, arg_max(ep, ep) AS e FROM (
      SELECT episode_path, {'last_updated': coalesce(last_updated, '0001-01-01'::TIMESTAMPTZ), 'task': coalesce(task, ''), 'robot': coalesce(robot, ''), 'operator': coalesce(operator, ''),
        'date': coalesce(date, ''), 'final_status': coalesce(final_status, ''), 'training_ready': coalesce(training_ready, false), 'metrics': coalesce(metrics, '')} AS ep FROM episodes
    ) GROUP BY episode_path)
), clean AS (
  SELECT episode_path, metrics,
    coalesce(nullif(regexp_replace(regexp_replace(lower(raw_task), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '(unknown)') AS task,
    coalesce(nullif(regexp_replace(regexp_replace(lower(raw_robot), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '(unknown)') AS robot
  FROM latest
)
"""

_P3 = (
    "WITH "
    + _LATEST
    + """, d AS (
  SELECT episode_path, task, robot,
    CASE WHEN json_valid(metrics) THEN try_cast(json_extract_string(metrics, '$.p2_duration_seconds') AS DOUBLE) END AS x
  FROM clean
), t AS (SELECT *, CASE WHEN x > 0 AND x <= 86400 THEN CAST(round(x * 1000) AS BIGINT) END AS duration FROM d),
f AS (SELECT episode_path, count(*) AS n, count(*) FILTER (WHERE status <> 'pass') AS flagged FROM (
  SELECT id, min(episode_path) AS episode_path, max(status) AS status FROM findings GROUP BY id) GROUP BY 1)
SELECT {key}, count(*) AS episodes, CAST(coalesce(sum(n), 0) AS BIGINT) AS findings,
  CAST(coalesce(sum(flagged), 0) AS BIGINT) AS flagged_findings,
  count(*) FILTER (WHERE flagged > 0) AS flagged_episodes,
  round(count(*) FILTER (WHERE flagged > 0) / count(*), 6) AS flagged_share,
  round(sum(duration) / 1000, 3) AS duration_seconds,
  round(sum(duration) / nullif(count(duration), 0) / 1000, 6) AS mean_duration
FROM t LEFT JOIN f USING (episode_path) GROUP BY {key}
"""
)

_P4_READINGS = r"""
WITH r AS (
  SELECT episode_path, modality, timestamp_ms AS t, NULL::DOUBLE AS v FROM frame_times
  WHERE lower(regexp_replace(is_new, '^\s+|\s+$', '', 'g')) IN ('1', 'true', 'yes')
  UNION ALL
  SELECT episode_path, 'observation.state.joint_position', timestamp_ms, j1
  FROM state_joint_position JOIN (
    SELECT episode_path, min(first_timestamp_ms) AS a, max(last_timestamp_ms) AS z FROM trim_plan GROUP BY 1
  ) USING (episode_path) WHERE timestamp_ms BETWEEN a AND z
), u AS (
  SELECT episode_path, modality, t, avg(v) AS v FROM r WHERE t IS NOT NULL AND NOT isnan(t) AND abs(t) <= 9e14 GROUP BY ALL
), n AS (
  SELECT *, lead(t) OVER (PARTITION BY episode_path, modality ORDER BY t) AS nx FROM u
), m AS (
  SELECT *, CAST(floor(t / 100) AS BIGINT) AS s, CASE WHEN nx - t <= 30000 THEN nx END AS nxt FROM n
)
"""


def oracle_sql() -> dict:
    p3 = lambda key: _P3.replace("{key}", key)
    return {
        "p1_found": _P1.replace("{flags}", ""),
        "p1_flags": _P1.replace("{flags}", ", spike, held, impossible"),
        "p3_by_task": p3("task"),
        "p3_by_robot": p3("robot"),
        "p3_task_robot_frames": "WITH "
        + _LATEST
        + r"""
SELECT task, robot, count(DISTINCT episode_path) AS episodes, count(*) AS frame_rows,
  CAST(sum(CASE WHEN lower(regexp_replace(is_new, '^\s+|\s+$', '', 'g')) IN ('1', 'true', 'yes')
    AND timestamp_ms IS NOT NULL AND NOT isnan(timestamp_ms) THEN 1 ELSE 0 END) AS BIGINT) AS fresh_rows
FROM clean JOIN frame_times USING (episode_path) GROUP BY 1, 2""",
        "p3_task_pairs": r"""
WITH a AS (SELECT nullif(regexp_replace(regexp_replace(lower(task), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS task FROM episodes),
b AS (SELECT nullif(regexp_replace(regexp_replace(lower(task), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS task,
  removed_total_ms AS x FROM trim_plan)
SELECT task, count(*) AS pairs, round(sum(x), 3) AS removed_ms FROM a JOIN b USING (task) GROUP BY 1""",
        "p4_found": _P4_READINGS
        + """SELECT episode_path, modality, unnest(range(s + 1, CAST(floor(nxt / 100) AS BIGINT))) AS slot FROM m WHERE nxt IS NOT NULL""",
        "p4_grid": _P4_READINGS
        + """, x AS (
  SELECT episode_path, modality, t, v, s, least(coalesce(nxt, 'infinity'::DOUBLE), t + 100) AS till,
    unnest(range(s, coalesce(CAST(floor(nxt / 100) AS BIGINT), s) + 1)) AS slot FROM m
), w AS (SELECT *, greatest(0.0, least(till, (slot + 1) * 100.0) - greatest(t, slot * 100.0)) AS w FROM x)
SELECT episode_path, modality, slot, count(*) FILTER (WHERE s = slot) AS n_readings,
  round(sum(w) / 100, 6) AS coverage,
  round(CASE WHEN sum(w) FILTER (WHERE v IS NOT NULL) > 0 THEN sum(w * v) / sum(w) FILTER (WHERE v IS NOT NULL) END, 6) AS mean_value,
  count(*) FILTER (WHERE s = slot) = 0 AS missing
FROM w GROUP BY 1, 2, 3""",
    }
