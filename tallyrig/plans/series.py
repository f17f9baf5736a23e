"""Sequence queries over frame times, poses and joint positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrig.config import DEFAULTS, by_robot, robots_sql
from tallyrig.functions import exprs as X
from tallyrig.functions.rotation import elements, gram_schmidt
from tallyrig.functions.text import is_fresh
from tallyrig.operators.ordered import CHUNK_ROWS, islands, one_row_each, over_rows, running_sum, with_halo, with_last_known, with_previous
from tallyrig.operators.quantile import grouped_median, grouped_quantiles
from tallyrig.operators.trajectory import SIDES
from tallyrig.operators.trajectory import trajectory_labels as label_trajectories
from tallyrig.plans.base import SQL, clean_episodes, metric
from tallyrig.plans.registry import Registry
from tallyrig.session import table

R = Registry()
FRAME = ["episode_path", "modality"]
JOINTS = [f"j{i}" for i in range(1, 8)]
HAND_AXES = [f"{s}_{a}" for s in SIDES for a in "xyz"]
_FINITE = "timestamp_ms IS NOT NULL AND isfinite(timestamp_ms)"
_FRESH = r"lower(regexp_replace(is_new, '^\s+|\s+$', '', 'g')) IN ('1', 'true', 'yes')"
_FRAMES = "WITH f AS (SELECT episode_path, modality, row_idx, min(timestamp_ms) AS timestamp_ms, min(is_new) AS is_new FROM frame_times GROUP BY ALL)"
_JOINTS = "WITH s AS (SELECT episode_path, row_idx, min(timestamp_ms) AS timestamp_ms, " + ", ".join(f"min({j}) AS {j}" for j in JOINTS) + ", min(gripper) AS gripper FROM state_joint_position GROUP BY ALL)"
_EACH = _JOINTS + ", u AS (SELECT * FROM (UNPIVOT s ON " + ", ".join(JOINTS) + " INTO NAME joint VALUE v) WHERE isfinite(v))"
_HANDS = (
    "WITH p AS (SELECT episode_path, row_idx, min(timestamp_ms) AS t, " + ", ".join(f"min({c}) AS {c}" for c in HAND_AXES) + " FROM actions_eef_pose GROUP BY ALL), h AS ("
    + " UNION ALL ".join(
        f"SELECT episode_path, row_idx, t, '{s}' AS side, {s}_x AS x, {s}_y AS y, {s}_z AS z FROM p WHERE isfinite({s}_x) AND isfinite({s}_y) AND isfinite({s}_z)"
        for s in SIDES
    )
    + "), m AS (SELECT *, sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2) + power(z - lag(z) OVER w, 2)) AS d FROM h {where} WINDOW w AS (PARTITION BY episode_path, side ORDER BY row_idx))"
)
_W = "WINDOW w AS (PARTITION BY episode_path, modality ORDER BY row_idx)"
_WE = "WINDOW w AS (PARTITION BY episode_path ORDER BY row_idx)"


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rows, each once."""
    return one_row_each(table(spark, sf_dir, "frame_times"), FRAME, "row_idx", ["timestamp_ms", "is_new"])


def joints(spark: SparkSession, sf_dir: str, values: tuple = (*JOINTS, "gripper")) -> DataFrame:
    """Joint rows, each once."""
    return one_row_each(table(spark, sf_dir, "state_joint_position"), ["episode_path"], "row_idx", ["timestamp_ms", *values])


def each_joint(rows: DataFrame) -> DataFrame:
    """Joint rows made one row for each finite reading: ``episode_path, joint, row_idx, v``."""
    pairs = F.array(*[F.struct(F.lit(j).alias("joint"), F.col(j).alias("v")) for j in JOINTS])
    return rows.select("episode_path", "row_idx", F.inline(pairs)).filter(X.finite(F.col("v")))


def poses(spark: SparkSession, sf_dir: str, values: list[str]) -> DataFrame:
    """Pose rows, each once."""
    return one_row_each(table(spark, sf_dir, "actions_eef_pose"), ["episode_path"], "row_idx", ["timestamp_ms", *values])


def hands(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Pose rows made one row for each side whose x, y and z are finite: ``keep, side, x, y, z``."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), *[F.col(f"{s}_{a}").alias(a) for a in "xyz"]) for s in SIDES])
    return rows.select(*keep, F.inline(sides)).filter(X.finite(F.col("x")) & X.finite(F.col("y")) & X.finite(F.col("z")))


def tier(ratio, fail: float = 0.05, review: float = 0.01):
    """The status of a share of violating rows."""
    return F.when(ratio <= 0, "pass").when(ratio >= fail, "fail").when(ratio >= review, "needs_review").otherwise("warning")


@R.add(
    _FRAMES
    + f""", g AS (SELECT *, lag(timestamp_ms) OVER w AS p FROM f WHERE {_FINITE} AND is_new = '1' {_W}),
a AS (SELECT episode_path, modality, count(*) AS n, count(*) FILTER (WHERE timestamp_ms <= p) AS violations, count(*) FILTER (WHERE timestamp_ms = p) AS equal_rows,
  count(*) FILTER (WHERE timestamp_ms < p) AS backward_rows, arg_min(timestamp_ms, row_idx) FILTER (WHERE timestamp_ms <= p) AS first_violation,
  count(*) - count(DISTINCT timestamp_ms) AS duplicates FROM g GROUP BY 1, 2)
SELECT *, round(violations / n, 6) AS ratio, CASE WHEN violations = 0 THEN 'pass' WHEN violations / n >= 0.05 THEN 'fail' WHEN violations / n >= 0.01 THEN 'needs_review' ELSE 'warning' END AS status FROM a"""
)
def monotonic_violations(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per stream: rows whose time does not rise, equal and backward ones apart, duplicate times, and the status."""
    t, p = F.col("timestamp_ms"), F.col("prev_timestamp_ms")
    rows = frames(spark, sf_dir).filter(X.finite(t) & (F.col("is_new") == "1"))
    seen = with_previous(rows, FRAME, "row_idx", ["timestamp_ms"], chunk_rows).groupBy(*FRAME).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t <= p).alias("violations"),
        F.count_if(t == p).alias("equal_rows"),
        F.count_if(t < p).alias("backward_rows"),
        F.min_by("timestamp_ms", F.when(t <= p, F.col("row_idx"))).alias("first_violation"),
    )
    # Times are made distinct by themselves, so that no stream's times gather in a task.
    times = rows.select(*FRAME, "timestamp_ms").distinct().groupBy(*FRAME).agg(F.count(F.lit(1)).alias("times"))
    ratio = F.col("violations") / F.col("n")
    out = seen.join(times, FRAME).withColumn("duplicates", F.col("n") - F.col("times")).drop("times")
    return out.withColumn("status", tier(ratio)).withColumn("ratio", F.round(ratio, 6))


@R.add(
    _FRAMES
    + f""", g AS (SELECT episode_path, modality, row_idx, NOT coalesce({_FRESH}, false) AS stale FROM f),
i AS (SELECT *, sum(CASE WHEN stale THEN 0 ELSE 1 END) OVER (PARTITION BY episode_path, modality ORDER BY row_idx) AS island FROM g),
r AS (SELECT episode_path, modality, island, count(*) FILTER (WHERE stale) AS len FROM i GROUP BY 1, 2, 3),
l AS (SELECT episode_path, modality, max(len) AS longest, sum(len) AS stale FROM r GROUP BY 1, 2),
c AS (SELECT episode_path, modality, count(*) AS n FROM g GROUP BY 1, 2)
SELECT episode_path, modality, n, CAST(stale AS BIGINT) AS stale, longest, round(stale / n, 6) AS drop_ratio, stale / n > 0.1 OR longest >= 25 AS flagged
FROM l JOIN c USING (episode_path, modality)"""
)
def drop_runs(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per stream: stale frames and the longest run of them."""
    rows = frames(spark, sf_dir).withColumn("stale", ~is_fresh(F.col("is_new"), F.lit(0.0)))
    runs = islands(rows, FRAME, "row_idx", ~F.col("stale"), chunk_rows).groupBy(*FRAME, "island").agg(
        F.count_if("stale").alias("len"), F.count(F.lit(1)).alias("rows")
    )
    out = runs.groupBy(*FRAME).agg(F.sum("rows").alias("n"), F.sum("len").alias("stale"), F.max("len").alias("longest"))
    ratio = F.col("stale") / F.col("n")
    return out.withColumn("drop_ratio", F.round(ratio, 6)).withColumn("flagged", (ratio > 0.1) | (F.col("longest") >= 25))


@R.add(
    SQL
    + f""", f AS (SELECT episode_path, modality, row_idx, min(timestamp_ms) AS t FROM frame_times WHERE {_FINITE} GROUP BY ALL),
a AS (SELECT episode_path, modality, count(*) AS n, arg_min(t, row_idx) AS a, arg_max(t, row_idx) AS z FROM f GROUP BY 1, 2),
x AS (SELECT a.*, (n - 1) / nullif((z - a) / 1000.0, 0) AS fps, {metric("p2_fps")} AS expected FROM a JOIN ep USING (episode_path))
SELECT episode_path, modality, n, round(fps, 6) AS actual_fps, expected AS expected_fps, CASE WHEN fps < expected * 0.9 THEN 'abnormal_fps_loss' WHEN fps > expected * 1.1 THEN 'abnormal_fps_gain' ELSE 'ok' END AS verdict
FROM x WHERE n > 1 AND fps > 0 AND expected > 0"""
)
def fps_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame rate a stream reaches against the one expected."""
    rows = frames(spark, sf_dir).filter(X.finite(F.col("timestamp_ms")))
    out = rows.groupBy(*FRAME).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("timestamp_ms", "row_idx").alias("a"), F.max_by("timestamp_ms", "row_idx").alias("z")
    )
    expected = clean_episodes(spark, sf_dir).select("episode_path", X.json_number(F.col("metrics"), "p2_fps").alias("expected_fps"))
    fps = (F.col("n") - 1) / F.nullif((F.col("z") - F.col("a")) / 1000.0, F.lit(0.0))
    out = out.withColumn("fps", fps).join(expected, "episode_path").filter("n > 1 AND fps > 0 AND expected_fps > 0")
    verdict = F.when(F.col("fps") < F.col("expected_fps") * 0.9, "abnormal_fps_loss").when(F.col("fps") > F.col("expected_fps") * 1.1, "abnormal_fps_gain").otherwise("ok")
    return out.select(*FRAME, "n", F.round("fps", 6).alias("actual_fps"), "expected_fps", verdict.alias("verdict"))


@R.add(
    f"""WITH b AS (SELECT episode_path, modality, min(timestamp_ms) AS a, max(timestamp_ms) AS z FROM frame_times WHERE {_FINITE} AND is_new = '1' GROUP BY 1, 2)
SELECT episode_path, count(*) AS modalities, round(max(a) - min(a), 6) AS start_spread, round(max(z) - min(z), 6) AS end_spread,
  min(modality) FILTER (WHERE a = ma) AS latest_start, max(a) - min(a) > 500 AS start_misaligned, max(z) - min(z) > 500 AS end_misaligned
FROM (SELECT *, max(a) OVER (PARTITION BY episode_path) AS ma FROM b) GROUP BY 1 HAVING count(*) >= 2"""
)
def alignment_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far apart an episode's streams start and end."""
    rows = table(spark, sf_dir, "frame_times").filter(X.finite(F.col("timestamp_ms")) & (F.col("is_new") == "1"))
    streams = rows.groupBy(*FRAME).agg(F.min("timestamp_ms").alias("a"), F.max("timestamp_ms").alias("z"))
    spread = lambda c: F.max(c) - F.min(c)
    out = streams.groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("modalities"),
        spread("a").alias("sa"),
        spread("z").alias("sz"),
        F.min_by("modality", F.struct(-F.col("a"), "modality")).alias("latest_start"),
    )
    return out.filter("modalities >= 2").select(
        "episode_path", "modalities", F.round("sa", 6).alias("start_spread"), F.round("sz", 6).alias("end_spread"), "latest_start",
        (F.col("sa") > 500).alias("start_misaligned"), (F.col("sz") > 500).alias("end_misaligned"),
    )


_STILL = " AND ".join(f"abs({j} - lag({j}) OVER w) < 0.001" for j in JOINTS)
_KEPT = (
    _JOINTS
    + f""", k0 AS (SELECT *, max(timestamp_ms) OVER (PARTITION BY episode_path ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM s WHERE {_FINITE}),
k AS (SELECT * FROM k0 WHERE top IS NULL OR timestamp_ms > top),
d AS (SELECT *, lag(timestamp_ms) OVER w AS pt, coalesce({_STILL}, false) AS still FROM k {_WE}),
i AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY episode_path ORDER BY row_idx) AS island FROM d),
seg AS (SELECT episode_path, island, min(timestamp_ms) AS a0, min(pt) FILTER (WHERE still) AS a, max(timestamp_ms) FILTER (WHERE still) AS z, count(*) FILTER (WHERE still) AS steps FROM i GROUP BY 1, 2),
b AS (SELECT episode_path, min(timestamp_ms) AS first_t, max(timestamp_ms) AS last_t FROM k GROUP BY 1)
"""
)


def kept_rows(rows: DataFrame, keys: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows whose time is later than every earlier row's (the monotonic part of a series).

    The highest time before a row is the running maximum; across chunks it is
    carried by one number a chunk.
    """
    base = rows.withColumn("__c", F.floor(F.col("row_idx") / chunk_rows)).repartition(*keys, "__c")
    by = Window.partitionBy(*keys, "__c").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    line = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    tops = base.groupBy(*keys, "__c").agg(F.max("timestamp_ms").alias("__m"))
    tops = tops.withColumn("__m", F.max("__m").over(line))
    inside = base.withColumn("__p", F.max("timestamp_ms").over(by))
    top = F.greatest("__p", "__m")
    return inside.join(tops, [*keys, "__c"]).filter(top.isNull() | (F.col("timestamp_ms") > top)).drop("__c", "__p", "__m")


def moving(within: float = 0.001):
    """Whether any joint moved since the row before; true where one is not known."""
    still = F.lit(True)
    for j in JOINTS:
        still = still & (F.abs(F.col(j) - F.col(f"prev_{j}")) < within)
    return ~F.coalesce(still, F.lit(False))


def still_segments(kept: DataFrame, within: float = 0.001, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Stretches of kept rows in which no joint moves: ``episode_path, start_ms, end_ms, steps``."""
    key = ["episode_path"]
    pairs = with_previous(kept, key, "row_idx", ["timestamp_ms", *JOINTS], chunk_rows)
    marked = pairs.select("episode_path", "row_idx", "timestamp_ms", "prev_timestamp_ms", moving(within).alias("moving"))
    return (
        islands(marked, key, "row_idx", F.col("moving"), chunk_rows)
        .filter("NOT moving")
        .groupBy("episode_path", "island")
        .agg(F.min("prev_timestamp_ms").alias("start_ms"), F.max("timestamp_ms").alias("end_ms"), F.count(F.lit(1)).alias("steps"))
        .drop("island")
    )


def kept_bounds(kept: DataFrame) -> DataFrame:
    """First and last time of each episode's kept rows."""
    return kept.groupBy("episode_path").agg(F.min("timestamp_ms").alias("first_t"), F.max("timestamp_ms").alias("last_t"))


@R.add(
    _KEPT
    + """SELECT seg.episode_path, a AS start_ms, z AS end_ms, steps, round(z - a, 6) AS duration_ms,
  CASE WHEN a - first_t <= 1000 THEN 'leading' WHEN last_t - z <= 1000 THEN 'trailing' ELSE 'middle' END AS location,
  CASE WHEN z - a >= 30000 THEN 'fail' WHEN z - a >= 10000 THEN 'needs_review' WHEN z - a >= 5000 THEN 'warning' ELSE 'pass' END AS status
FROM seg JOIN b USING (episode_path) WHERE steps > 0 AND z - a > 500"""
)
def stillness_segments(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Standstill of more than half a second: where it is in the episode and how bad."""
    kept = kept_rows(joints(spark, sf_dir).filter(X.finite(F.col("timestamp_ms"))), ["episode_path"], chunk_rows)
    d = F.col("end_ms") - F.col("start_ms")
    location = F.when(F.col("start_ms") - F.col("first_t") <= 1000, "leading").when(F.col("last_t") - F.col("end_ms") <= 1000, "trailing").otherwise("middle")
    status = F.when(d >= 30000, "fail").when(d >= 10000, "needs_review").when(d >= 5000, "warning").otherwise("pass")
    return still_segments(kept, chunk_rows=chunk_rows).filter(d > 500).join(kept_bounds(kept), "episode_path").select(
        "episode_path", "start_ms", "end_ms", "steps", F.round(d, 6).alias("duration_ms"), location.alias("location"), status.alias("status")
    )


@R.add(
    _KEPT
    + """, e AS (SELECT b.episode_path, first_t, last_t, max(z) FILTER (WHERE a - first_t <= 1000 AND z - a >= 5000) AS lead_end,
  min(a) FILTER (WHERE last_t - z <= 1000 AND a - first_t > 1000 AND z - a >= 5000) AS trail_start FROM b LEFT JOIN seg ON seg.episode_path = b.episode_path AND steps > 0 GROUP BY 1, 2, 3),
x AS (SELECT *, CASE WHEN lead_end IS NULL THEN first_t ELSE greatest(first_t, lead_end - 500) END AS kept_a, CASE WHEN trail_start IS NULL THEN last_t ELSE least(last_t, trail_start + 500) END AS kept_z FROM e)
SELECT episode_path, first_t AS first_timestamp_ms, last_t AS last_timestamp_ms, kept_a AS first_kept_timestamp_ms, kept_z AS last_kept_timestamp_ms,
  round(first_t - kept_a + kept_z - kept_z + kept_a - first_t + (kept_a - first_t) + (last_t - kept_z), 6) AS removed_total_ms, round(kept_z - kept_a, 6) AS remaining_duration_ms,
  CASE WHEN kept_a = first_t AND kept_z = last_t THEN 'no_trim' WHEN kept_z - kept_a < 5000 THEN 'reject_too_short_after_trim'
    WHEN ((kept_a - first_t) + (last_t - kept_z)) / (last_t - first_t) > 0.4 THEN 'needs_review' ELSE 'trim_candidate' END AS decision FROM x"""
)
def trim_plan_recomputed(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """What to cut off at both ends of an episode, keeping half a second of the standstill."""
    kept = kept_rows(joints(spark, sf_dir).filter(X.finite(F.col("timestamp_ms"))), ["episode_path"], chunk_rows)
    bounds = kept_bounds(kept)
    long = still_segments(kept, chunk_rows=chunk_rows).filter("end_ms - start_ms >= 5000")
    joined = bounds.join(long, "episode_path", "left")
    leading = F.col("start_ms") - F.col("first_t") <= 1000
    trailing = (F.col("last_t") - F.col("end_ms") <= 1000) & ~leading
    e = joined.groupBy("episode_path", "first_t", "last_t").agg(
        F.max(F.when(leading, F.col("end_ms"))).alias("lead_end"), F.min(F.when(trailing, F.col("start_ms"))).alias("trail_start")
    )
    a = F.greatest("first_t", F.coalesce(F.col("lead_end") - 500, "first_t"))
    z = F.least("last_t", F.coalesce(F.col("trail_start") + 500, "last_t"))
    e = e.withColumn("a", a).withColumn("z", z)
    removed = (F.col("a") - F.col("first_t")) + (F.col("last_t") - F.col("z"))
    decision = (
        F.when((F.col("a") == F.col("first_t")) & (F.col("z") == F.col("last_t")), "no_trim")
        .when(F.col("z") - F.col("a") < 5000, "reject_too_short_after_trim")
        .when(F.try_divide(removed, F.col("last_t") - F.col("first_t")) > DEFAULTS["phase7"]["trim_ratio"], "needs_review")
        .otherwise("trim_candidate")
    )
    return e.select(
        "episode_path", F.col("first_t").alias("first_timestamp_ms"), F.col("last_t").alias("last_timestamp_ms"),
        F.col("a").alias("first_kept_timestamp_ms"), F.col("z").alias("last_kept_timestamp_ms"),
        F.round(removed, 6).alias("removed_total_ms"), F.round(F.col("z") - F.col("a"), 6).alias("remaining_duration_ms"), decision.alias("decision"),
    )


@R.add(
    _EACH
    + """, r AS (SELECT episode_path, joint, v - avg(v) OVER (PARTITION BY episode_path, joint ORDER BY row_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS d FROM u),
a AS (SELECT episode_path, joint, avg(abs(d)) AS j FROM r GROUP BY 1, 2)
SELECT episode_path, joint, round(j, 6) AS jitter, CASE WHEN j >= 0.05 THEN 'fail' WHEN j >= 0.01 THEN 'warning' ELSE 'pass' END AS status FROM a"""
)
def jitter_score(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean distance of each joint from its centred moving average of five finite readings."""
    key = ["episode_path", "joint"]

    def off(rows: DataFrame, by) -> DataFrame:
        return rows.withColumn("d", F.abs(F.col("v") - F.avg("v").over(by.rowsBetween(-2, 2))))

    offs = over_rows(each_joint(joints(spark, sf_dir, JOINTS)), key, "row_idx", off, 2, 2, chunk_rows)
    j = F.col("jitter")
    return offs.groupBy(*key).agg(F.avg("d").alias("jitter")).select(
        *key, F.round(j, 6).alias("jitter"), F.when(j >= 0.05, "fail").when(j >= 0.01, "warning").otherwise("pass").alias("status")
    )


@R.add(
    SQL.rstrip() + ", " + robots_sql() + ", " + _EACH.removeprefix("WITH ")
    + """, v AS (SELECT episode_path, joint, (v - lag(v) OVER w) / nullif((timestamp_ms - lag(timestamp_ms) OVER w) / 1000.0, 0) AS v, timestamp_ms - lag(timestamp_ms) OVER w AS dt
  FROM u WHERE isfinite(timestamp_ms) WINDOW w AS (PARTITION BY episode_path, joint ORDER BY row_idx))
SELECT episode_path, joint, count(*) AS steps, round(quantile_cont(abs(v), 0.99), 4) AS p99_velocity, round(max(abs(v)), 4) AS max_velocity,
  quantile_cont(abs(v), 0.99) > any_value(velocity) AS exceeded FROM v LEFT JOIN ep USING (episode_path) JOIN limits l ON l.robot = CASE WHEN ep.robot IN (SELECT robot FROM limits) THEN ep.robot ELSE '' END WHERE dt > 0 GROUP BY 1, 2"""
)
def velocity_p99(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The 99th percentile of each joint's speed between its readings whose time rises."""
    rows = joints(spark, sf_dir, JOINTS).filter(X.finite(F.col("timestamp_ms")))
    readings = [F.when(X.finite(F.col(j)), F.struct(F.col("timestamp_ms").alias("t"), F.col(j).alias("v"))).alias(j) for j in JOINTS]
    pairs = with_last_known(rows.select("episode_path", "row_idx", *readings), ["episode_path"], "row_idx", JOINTS, chunk_rows)
    dt = lambda j: (F.col(f"{j}.t") - F.col(f"prev_{j}.t")) / 1000.0
    speed = lambda j: F.when(dt(j) > 0, F.abs((F.col(f"{j}.v") - F.col(f"prev_{j}.v")) / dt(j)))
    made = F.array(*[F.struct(F.lit(j).alias("joint"), speed(j).alias("v")) for j in JOINTS])
    speeds = pairs.select("episode_path", F.inline(made)).filter("v IS NOT NULL")
    key = ["episode_path", "joint"]
    most = speeds.groupBy(*key).agg(F.max("v").alias("m"))
    out = grouped_quantiles(speeds, key, "v", {"p": 0.99}).join(most, key)
    out = out.join(clean_episodes(spark, sf_dir).select("episode_path", "robot"), "episode_path", "left")
    return out.select(*key, F.col("n").alias("steps"), F.round("p", 4).alias("p99_velocity"), F.round("m", 4).alias("max_velocity"), (F.col("p") > by_robot(F.col("robot"), "velocity")).alias("exceeded"))


@R.add(
    SQL.rstrip() + ", " + robots_sql() + ", " + _EACH.removeprefix("WITH ")
    + """, b AS (SELECT u.*, joint_low, joint_high FROM u LEFT JOIN ep USING (episode_path) JOIN limits l ON l.robot = CASE WHEN ep.robot IN (SELECT robot FROM limits) THEN ep.robot ELSE '' END)
SELECT episode_path, joint, count(*) AS readings, count(*) FILTER (WHERE v < joint_low - 0.003 OR v > joint_high + 0.003) AS violations, round(max(greatest(joint_low - v, v - joint_high)), 6) AS worst FROM b GROUP BY 1, 2"""
)
def limit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint readings beyond the limits of the episode's robot with the usual tolerance."""
    low, high, slack = by_robot(F.col("robot"), "joint_low"), by_robot(F.col("robot"), "joint_high"), DEFAULTS["phase5"]["tolerance"]
    v = F.col("v")
    rows = each_joint(joints(spark, sf_dir, JOINTS)).join(clean_episodes(spark, sf_dir).select("episode_path", "robot"), "episode_path", "left")
    beyond = (v < low - slack) | (v > high + slack)
    return rows.groupBy("episode_path", "joint").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(beyond).alias("violations"), F.round(F.max(F.greatest(low - v, v - high)), 6).alias("worst")
    )


@R.add(
    _HANDS.format(where="WHERE abs(x) < 1e6")
    + """ SELECT episode_path, side, count(*) AS rows, round(sum(d), 4) AS path_length, round(max(x) - min(x) + max(y) - min(y) + max(z) - min(z), 4) AS extent,
  count(*) FILTER (WHERE d > 0.05) AS large_steps, round(max(d), 6) AS largest_step FROM m GROUP BY 1, 2"""
)
def path_and_steps(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Length, extent and large steps of each hand's path, one row an episode and side."""
    axes, key = ["x", "y", "z"], ["episode_path", "side"]
    rows = hands(poses(spark, sf_dir, HAND_AXES), ["episode_path", "row_idx"]).filter(F.abs("x") < 1e6)
    pairs = with_previous(rows, key, "row_idx", axes, chunk_rows)
    d = F.sqrt(sum(F.pow(F.col(a) - F.col(f"prev_{a}"), 2) for a in axes))
    extent = sum(F.max(a) - F.min(a) for a in axes)
    return pairs.withColumn("d", d).groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("d"), 4).alias("path_length"), F.round(extent, 4).alias("extent"),
        F.count_if(F.col("d") > 0.05).alias("large_steps"), F.round(F.max("d"), 6).alias("largest_step"),
    )


@R.add(
    _FRAMES
    + f""", g AS (SELECT episode_path, modality, row_idx, coalesce({_FRESH}, false) AS state FROM f),
c AS (SELECT *, CASE WHEN state = lag(state) OVER w THEN 0 ELSE 1 END AS new FROM g {_W}),
i AS (SELECT *, sum(new) OVER (PARTITION BY episode_path, modality ORDER BY row_idx) AS island FROM c)
SELECT episode_path, modality, state, min(row_idx) AS first_row, max(row_idx) AS last_row, count(*) AS len FROM i GROUP BY episode_path, modality, island, state"""
)
def rle_segments(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Run-length encoding of fresh and stale frames."""
    rows = frames(spark, sf_dir).select(*FRAME, "row_idx", is_fresh(F.col("is_new"), F.lit(0.0)).alias("state"))
    pairs = with_previous(rows, FRAME, "row_idx", ["state"], chunk_rows)
    opened = islands(pairs, FRAME, "row_idx", ~F.col("state").eqNullSafe(F.col("prev_state")), chunk_rows)
    return opened.groupBy(*FRAME, "island", "state").agg(
        F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"), F.count(F.lit(1)).alias("len")
    ).drop("island")


@R.add(
    _HANDS.format(where="WHERE isfinite(t)")
    + """, g AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY episode_path, side ORDER BY t, row_idx) >= 500, true) AS new FROM m WHERE d > 0.01),
i AS (SELECT *, count(*) FILTER (WHERE new) OVER (PARTITION BY episode_path, side ORDER BY t, row_idx) AS session FROM g)
SELECT episode_path, side, min(t) AS start_ms, max(t) AS end_ms, count(*) AS fast_rows FROM i GROUP BY episode_path, side, session"""
)
def session_merge(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS, chunk_ms: int = 600_000) -> DataFrame:
    """Fast moves of each hand merged into one while less than half a second apart.

    Fast rows are few; they are chunked by their time.
    """
    axes, key = ["x", "y", "z"], ["episode_path", "side"]
    rows = hands(poses(spark, sf_dir, HAND_AXES).filter(X.finite(F.col("timestamp_ms"))), ["episode_path", "row_idx", "timestamp_ms"])
    pairs = with_previous(rows, key, "row_idx", axes, chunk_rows)
    d = F.sqrt(sum(F.pow(F.col(a) - F.col(f"prev_{a}"), 2) for a in axes))
    fast = pairs.filter(d > 0.01).select(*key, "row_idx", F.col("timestamp_ms").alias("t"))
    # A total order over time, then row.
    moments = fast.groupBy(*key, "t").agg(F.count(F.lit(1)).alias("n"))
    gaps = with_previous(moments, key, "t", ["t"], chunk_rows=chunk_ms)
    opened = islands(gaps, key, "t", F.coalesce(F.col("t") - F.col("prev_t") >= 500, F.lit(True)), chunk_rows=chunk_ms)
    return opened.groupBy(*key, "island").agg(
        F.min("t").alias("start_ms"), F.max("t").alias("end_ms"), F.sum("n").alias("fast_rows")
    ).drop("island")


@R.add(
    _HANDS.format(where="")
    + """, f AS (SELECT episode_path, side, CAST(floor(t) AS BIGINT) AS ms, arg_min({'x': x, 'y': y, 'z': z}, (row_idx, x, y, z)) AS p FROM h WHERE isfinite(t) AND abs(t) < 1e12 GROUP BY 1, 2, 3),
q AS (SELECT *, first_value(p) OVER (PARTITION BY episode_path, side ORDER BY ms RANGE BETWEEN 500 PRECEDING AND CURRENT ROW) AS p0 FROM f),
e AS (SELECT episode_path, side, sqrt(power(p.x - p0.x, 2) + power(p.y - p0.y, 2) + power(p.z - p0.z, 2)) AS d FROM q)
SELECT episode_path, side, count(*) AS moments, round(max(d), 6) AS largest, count(*) FILTER (WHERE d > 0.35) AS jumps FROM e GROUP BY 1, 2"""
)
def trailing_displacement(spark: SparkSession, sf_dir: str, chunk_ms: int = 300_000) -> DataFrame:
    """How far each hand gets within half a second, in space; of rows in one millisecond the first counts."""
    key = ["episode_path", "side"]
    rows = table(spark, sf_dir, "actions_eef_pose").filter(
        X.finite(F.col("timestamp_ms")) & (F.abs("timestamp_ms") < 1e12) & F.col("episode_path").isNotNull()
    )
    rows = hands(rows, ["episode_path", "row_idx", F.floor("timestamp_ms").alias("ms")])
    rows = rows.groupBy(*key, "ms").agg(F.min(F.struct("row_idx", "x", "y", "z")).alias("p"))
    near = with_halo(rows, key, "ms", halo=500, chunk=chunk_ms)
    by = Window.partitionBy(*key, "__c").orderBy("ms").rangeBetween(-500, 0)
    d = F.sqrt(sum(F.pow(F.col(f"p.{a}") - F.col(f"then.{a}"), 2) for a in "xyz"))
    moved = near.withColumn("then", F.first("p").over(by)).withColumn("d", d).filter("__native")
    return moved.groupBy(*key).agg(
        F.count(F.lit(1)).alias("moments"), F.round(F.max("d"), 6).alias("largest"), F.count_if(F.col("d") > 0.35).alias("jumps")
    )


@R.add(
    f"""WITH u AS (SELECT DISTINCT episode_path, modality, timestamp_ms AS t FROM frame_times WHERE {_FINITE} AND {_FRESH}),
g AS (SELECT *, t - lag(t) OVER (PARTITION BY episode_path, modality ORDER BY t) AS gap FROM u),
m AS (SELECT episode_path, modality, median(gap) AS period FROM g GROUP BY 1, 2),
x AS (SELECT g.*, CAST(floor((gap + 0.25 * period) / period) AS BIGINT) - 1 AS missing FROM g JOIN m USING (episode_path, modality) WHERE period > 0)
SELECT episode_path, modality, count(*) AS gaps, CAST(sum(missing) AS BIGINT) AS missing_frames, max(missing) AS longest FROM x WHERE missing > 0 GROUP BY 1, 2"""
)
def missing_inferred(spark: SparkSession, sf_dir: str, chunk_ms: int = 300_000) -> DataFrame:
    """Frames that gaps in fresh times, however long, suggest are missing."""
    rows = table(spark, sf_dir, "frame_times").filter(
        is_fresh(F.col("is_new"), F.col("timestamp_ms")) & X.finite(F.col("timestamp_ms")) & F.col("episode_path").isNotNull() & F.col("modality").isNotNull()
    )
    times = rows.select(*FRAME, F.col("timestamp_ms").alias("t")).distinct()
    gaps = with_previous(times, FRAME, "t", ["t"], chunk_rows=chunk_ms).withColumn("gap", F.col("t") - F.col("prev_t"))
    period = grouped_median(gaps, FRAME, "gap", "period").filter("period > 0")
    missing = F.floor((F.col("gap") + 0.25 * F.col("period")) / F.col("period")) - 1
    return gaps.join(period, FRAME).withColumn("missing", missing).filter("missing > 0").groupBy(*FRAME).agg(
        F.count(F.lit(1)).alias("gaps"), F.sum("missing").alias("missing_frames"), F.max("missing").alias("longest")
    )


@R.add(
    _EACH
    + """, a AS (SELECT episode_path, joint, row_idx, degrees(v) * 4 AS deg FROM u),
d AS (SELECT *, deg - lag(deg) OVER w AS raw FROM a WINDOW w AS (PARTITION BY episode_path, joint ORDER BY row_idx)),
q AS (SELECT *, coalesce(raw + 180 - 360 * floor((raw + 180) / 360) - 180, deg) AS step FROM d)
SELECT episode_path, joint, round(max(c) - min(c), 4) AS swept_degrees, round(arg_max(c, row_idx), 4) AS last_angle
FROM (SELECT *, sum(step) OVER (PARTITION BY episode_path, joint ORDER BY row_idx) AS c FROM q) GROUP BY 1, 2"""
)
def unwrap_degrees(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Angles of each joint made continuous over full turns."""
    key = ["episode_path", "joint"]
    rows = each_joint(joints(spark, sf_dir, JOINTS)).select(*key, "row_idx", (F.degrees("v") * 4).alias("deg"))
    pairs = with_previous(rows, key, "row_idx", ["deg"], chunk_rows)
    step = F.pmod(F.col("deg") - F.col("prev_deg") + 180, F.lit(360.0)) - 180
    turned = running_sum(pairs, key, "row_idx", F.coalesce(step, F.col("deg")), "c", chunk_rows)
    return turned.groupBy(*key).agg(
        F.round(F.max("c") - F.min("c"), 4).alias("swept_degrees"), F.round(F.max_by("c", "row_idx"), 4).alias("last_angle")
    )


@R.add(
    _JOINTS
    + f""", d AS (SELECT episode_path, row_idx, CASE WHEN coalesce({_STILL}, false) THEN 1.0 ELSE 0.0 END AS still FROM s {_WE}),
k AS (SELECT *, avg(still) OVER w5 AS share, count(*) OVER w5 AS n FROM d WINDOW w5 AS (PARTITION BY episode_path ORDER BY row_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT episode_path, count(*) AS windows, count(*) FILTER (WHERE share >= 0.8) AS still_windows, min(row_idx) FILTER (WHERE share >= 0.8) AS first_still_row FROM k WHERE n = 5 GROUP BY 1"""
)
def still_windows(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sliding windows of five rows of which at least four stand still."""
    key = ["episode_path"]
    pairs = with_previous(joints(spark, sf_dir), key, "row_idx", JOINTS, chunk_rows)
    marked = pairs.select("episode_path", "row_idx", F.when(moving(), 0.0).otherwise(1.0).alias("still"))

    def share(rows: DataFrame, by) -> DataFrame:
        last = by.rowsBetween(-4, 0)
        return rows.withColumn("share", F.avg("still").over(last)).withColumn("n", F.count(F.lit(1)).over(last))

    k = over_rows(marked, key, "row_idx", share, 4, 0, chunk_rows).filter("n = 5")
    return k.groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(F.col("share") >= 0.8).alias("still_windows"), F.min(F.when(F.col("share") >= 0.8, F.col("row_idx"))).alias("first_still_row")
    )


@R.add(
    SQL
    + r""", e AS (SELECT task, CAST(regexp_extract(episode_path, 'episode_(\d+)', 1) AS INT) AS number, final_status IN ('fail', 'needs_review') AS bad FROM ep),
b AS (SELECT DISTINCT task, number FROM e WHERE bad), x AS (SELECT *, number - row_number() OVER (PARTITION BY task ORDER BY number) AS g FROM b)
SELECT task, min(number) AS episode_start, max(number) AS episode_end, count(*) AS streak_length FROM x GROUP BY task, g HAVING count(*) >= 2"""
)
def streak_segments(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Runs of bad episodes with consecutive numbers in a task."""
    number = F.regexp_extract("episode_path", r"episode_(\d+)", 1).try_cast("int")
    bad = clean_episodes(spark, sf_dir).filter(F.col("final_status").isin("fail", "needs_review"))
    # Tidied names are never empty, so '' stands for none.
    named = bad.select(F.coalesce("task", F.lit("")).alias("task"), number.alias("number")).filter("number IS NOT NULL")
    return bad_streaks(named, ["task"], least=2, chunk_rows=chunk_rows).withColumn("task", F.nullif("task", F.lit("")))


def bad_streaks(bad: DataFrame, keys: list[str], least: int = 5, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Maximal runs of consecutive ``number`` in each group, of ``least`` or more.

    Keys and numbers are not null.  A group may hold most rows; it is cut into
    chunks of its numbers.
    """
    numbers = with_previous(bad.select(*keys, "number").distinct(), keys, "number", ["number"], chunk_rows)
    opens = F.coalesce(F.col("number") - F.col("prev_number") > 1, F.lit(True))
    runs = islands(numbers, keys, "number", opens, chunk_rows).groupBy(*keys, "island")
    return runs.agg(
        F.min("number").alias("episode_start"), F.max("number").alias("episode_end"), F.count(F.lit(1)).alias("streak_length")
    ).filter(F.col("streak_length") >= least).drop("island")


@R.add()
def trajectory_labels(spark: SparkSession, sf_dir: str, chunk_ms: int = 600_000) -> DataFrame:
    """The label of each pose stream, and whether it is kept, mended, cropped or rejected."""
    return label_trajectories(table(spark, sf_dir, "actions_eef_pose"), chunk_ms=chunk_ms)


_SIX = [f"left_r{i}" for i in range(1, 7)]
_SIX_OK = " AND ".join(f"isfinite({c})" for c in _SIX)


@R.add(
    "WITH p AS (SELECT episode_path, row_idx, " + ", ".join(f"min({c}) AS {c}" for c in _SIX) + " FROM actions_eef_pose GROUP BY ALL),"
    f"""a AS (SELECT *, sqrt(left_r1 * left_r1 + left_r2 * left_r2 + left_r3 * left_r3) AS n FROM p WHERE {_SIX_OK}),
b AS (SELECT *, left_r1 / n AS x1, left_r2 / n AS x2, left_r3 / n AS x3 FROM a WHERE n > 1e-9),
c AS (SELECT *, x1 * left_r4 + x2 * left_r5 + x3 * left_r6 AS d FROM b),
e AS (SELECT *, left_r4 - d * x1 AS u1, left_r5 - d * x2 AS u2, left_r6 - d * x3 AS u3 FROM c),
f AS (SELECT *, sqrt(u1 * u1 + u2 * u2 + u3 * u3) AS m FROM e)
SELECT episode_path, count(*) AS rows, round(avg(x1), 5) AS forward_x, round(avg(u2 / m), 5) AS side_y, round(avg((x1 * u2 - x2 * u1) / m), 5) AS up_z FROM f WHERE m > 1e-9 GROUP BY 1"""
)
def pose_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean axes of the left hand, its six numbers made a rotation matrix."""
    rows = poses(spark, sf_dir, _SIX)
    good = F.lit(True)
    for c in _SIX:
        good = good & X.finite(F.col(c))
    made = rows.filter(good).withColumn("m", F.array(*gram_schmidt([F.col(c) for c in _SIX])))
    m = elements("m", 9)
    return made.filter(m[0].isNotNull() & m[3].isNotNull()).groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(m[0]), 5).alias("forward_x"), F.round(F.avg(m[4]), 5).alias("side_y"), F.round(F.avg(m[8]), 5).alias("up_z")
    )


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
