"""Selecting, joining and checking episodes: contexts, filters, joins, phase checks, store planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrig.config import DEFAULTS
from tallyrig.functions import exprs as X
from tallyrig.functions.text import is_fresh
from tallyrig.plans.base import SQL, clean_episodes, clean_findings, metric
from tallyrig.plans.registry import Registry
from tallyrig.plans.reports import UNKNOWN
from tallyrig.plans.series import FRAME, frames, joints
from tallyrig.session import table

R = Registry()
_ROBOTS = ("umi", "aloha", "arx5", "franka", "flexiv", "ur")
_FINITE = "timestamp_ms IS NOT NULL AND isfinite(timestamp_ms)"


@R.add(
    r"""WITH p AS (SELECT DISTINCT episode_path, string_split(episode_path, '/') AS parts FROM episodes),
d AS (SELECT *, list_filter(parts, lambda x: regexp_full_match(x, '\d{8}'))[1] AS date FROM p), a AS (SELECT *, list_position(parts, date) AS pos, string_split(parts[-1], '_') AS tail FROM d),
r AS (SELECT *, coalesce(parts[pos - 2] IN ('umi', 'aloha', 'arx5', 'franka', 'flexiv', 'ur') AND starts_with(parts[pos - 1], 'rig'), false) AS rig FROM a)
SELECT episode_path, CASE WHEN pos > 0 THEN CASE WHEN rig THEN parts[pos - 3] ELSE parts[pos - 1] END END AS task, date, CASE WHEN pos > 0 THEN parts[pos + 1] END AS operator,
  CASE WHEN rig THEN parts[pos - 2] WHEN len(tail) >= 5 THEN tail[5] END AS robot, CASE WHEN len(tail) >= 6 THEN array_to_string(tail[6:], '_') END AS controller,
  try_cast(regexp_extract(parts[-1], '^episode_(\d+)', 1) AS INT) AS number FROM r"""
)
def context_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each path says about its episode."""
    paths = table(spark, sf_dir, "episodes").select("episode_path").distinct()
    return paths.select("episode_path", *[c.alias(n) for n, c in X.path_context(F.col("episode_path")).items()])


@R.add(
    SQL
    + """SELECT episode_path, date, task FROM ep WHERE date BETWEEN '20260401' AND '20260630' AND episode_path LIKE '%/%2026%' AND contains(lower(episode_path), 'pack_the') ORDER BY episode_path LIMIT 100"""
)
def select_by_date_and_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred paths of a date range and a task text."""
    rows = clean_episodes(spark, sf_dir).filter(F.col("date").between("20260401", "20260630"))
    rows = rows.filter(F.col("episode_path").like("%/%2026%") & F.lower("episode_path").contains("pack_the"))
    return rows.select("episode_path", "date", "task").orderBy("episode_path").limit(100)


@R.add(
    SQL
    + """SELECT episode_path, 6 AS phase FROM ep WHERE NOT coalesce(list_contains(phases_completed, 6), false)
AND NOT coalesce(list_bool_or(list_transform(map_entries(phase_status), lambda x: x.key < 6 AND x.value = 'fail')), false)"""
)
def phases_to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose phase 6 is open and no earlier phase failed."""
    rows = clean_episodes(spark, sf_dir)
    done = F.coalesce(F.array_contains("phases_completed", 6), F.lit(False))
    failed = F.exists(F.map_entries("phase_status"), lambda e: (e.key < 6) & (e.value == "fail"))
    return rows.filter(~done & ~F.coalesce(failed, F.lit(False))).select("episode_path", F.lit(6).alias("phase"))


@R.add(
    SQL
    + """SELECT episode_path, len(list_filter(phases_completed, lambda x: x NOT IN (3, 5))) AS phases_left, array_to_string(list_sort(list_filter(phases_completed, lambda x: x NOT IN (3, 5))), ',') AS phases FROM ep WHERE phases_completed IS NOT NULL"""
)
def force_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed phases after phases 3 and 5 are reset."""
    left = F.filter("phases_completed", lambda x: ~x.isin(3, 5))
    rows = clean_episodes(spark, sf_dir).filter("phases_completed IS NOT NULL")
    return rows.select("episode_path", F.size(left).alias("phases_left"), F.array_join(F.sort_array(left), ",").alias("phases"))


@R.add(
    SQL
    + """SELECT episode_path, CASE WHEN robot IS NOT NULL THEN robot = 'umi' ELSE contains(lower(episode_path), '_umi') OR coalesce(contains(task, 'umi'), false) END AS umi FROM ep"""
)
def umi_applicability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an episode is of the handheld kind: by robot, else by its path and task."""
    by_name = F.lower("episode_path").contains("_umi") | F.coalesce(F.col("task").contains("umi"), F.lit(False))
    umi = F.when(F.col("robot").isNotNull(), F.col("robot") == "umi").otherwise(by_name)
    return clean_episodes(spark, sf_dir).select("episode_path", umi.alias("umi"))


@R.add(
    SQL
    + """SELECT CASE WHEN hour(last_updated AT TIME ZONE 'UTC') < 12 THEN 'forenoon' WHEN hour(last_updated AT TIME ZONE 'UTC') < 18 THEN 'afternoon' ELSE 'evening' END AS part,
  strftime(last_updated AT TIME ZONE 'UTC', '%Y%m%d') AS day, count(*) AS episodes, count(*) FILTER (WHERE final_status = 'fail') AS failed FROM ep WHERE last_updated IS NOT NULL GROUP BY 1, 2"""
)
def half_day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes by named half-open parts of the UTC day."""
    # Counted from the epoch, so the session's time zone has no say.
    second = F.floor(F.unix_micros("last_updated") / 1_000_000)
    hour = F.floor(F.pmod(second, F.lit(86400)) / 3600)
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(second / 86400).cast("int")), "yyyyMMdd")
    part = F.when(hour < 12, "forenoon").when(hour < 18, "afternoon").otherwise("evening")
    rows = clean_episodes(spark, sf_dir).filter("last_updated IS NOT NULL")
    return rows.groupBy(part.alias("part"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("final_status") == "fail").alias("failed")
    )


_NOTE = DEFAULTS["notifications"]
_TEXTS = {k: ", ".join(f"'{v}'" for v in values) for k, values in _NOTE.items()}


@R.add(
    SQL
    + f"""SELECT id, check_name, CASE WHEN check_name IN ({_TEXTS["exclude"]}) THEN 'skip' WHEN status IN ({_TEXTS["statuses"]}) THEN 'publish'
  WHEN status IN ({_TEXTS["actionable_statuses"]}) AND check_name IN ({_TEXTS["actionable"]}) THEN 'publish' ELSE 'skip' END AS action FROM fd"""
)
def notification_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which findings are announced."""
    c, s = F.col("check_name"), F.col("status")
    wanted = s.isin(*_NOTE["statuses"]) | (s.isin(*_NOTE["actionable_statuses"]) & c.isin(*_NOTE["actionable"]))
    action = F.when(c.isin(*_NOTE["exclude"]), "skip").when(wanted, "publish").otherwise("skip")
    return clean_findings(spark, sf_dir).select("id", "check_name", action.alias("action"))


@R.add(SQL + "SELECT fd.id, fd.episode_path, check_name FROM fd WHERE episode_path IN (SELECT episode_path FROM ep WHERE final_status = 'pass')")
def findings_of_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of episodes that passed all the same (semi join)."""
    good = clean_episodes(spark, sf_dir).filter(F.col("final_status") == "pass").select("episode_path")
    return clean_findings(spark, sf_dir).select("id", "episode_path", "check_name").join(good, "episode_path", "left_semi")


@R.add(
    SQL
    + """SELECT episode_path FROM ep WHERE NOT coalesce(list_contains(map_values(phase_status), 'fail'), false) AND NOT coalesce(list_contains(phases_completed, 6), false) AND (final_status = 'umi_pending' OR robot = 'umi')"""
)
def deferred_umi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes whose handheld processing was put off."""
    failed = F.coalesce(F.array_contains(F.map_values("phase_status"), "fail"), F.lit(False))
    done = F.coalesce(F.array_contains("phases_completed", 6), F.lit(False))
    return clean_episodes(spark, sf_dir).filter(~failed & ~done & ((F.col("final_status") == "umi_pending") | (F.col("robot") == "umi"))).select("episode_path")


@R.add(SQL + "SELECT id, phase, episode_path FROM fd WHERE phase = 0 OR episode_path IN (SELECT episode_path FROM ep WHERE date >= '20260601')")
def prune_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings a store keeps for a selection of episodes; discovery findings stay."""
    chosen = clean_episodes(spark, sf_dir).filter(F.col("date") >= "20260601").select("episode_path", F.lit(True).alias("chosen"))
    rows = clean_findings(spark, sf_dir).select("id", "phase", "episode_path").join(chosen, "episode_path", "left")
    return rows.filter((F.col("phase") == 0) | F.col("chosen")).drop("chosen")


@R.add(
    """SELECT episode_path, task, epoch_us(last_updated) AS updated_us FROM episodes QUALIFY row_number() OVER (PARTITION BY episode_path ORDER BY last_updated DESC NULLS LAST, task DESC NULLS LAST) = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each key by an aggregate that combines early."""
    rows = table(spark, sf_dir, "episodes").groupBy("episode_path").agg(F.max(F.struct("last_updated", "task")).alias("e"))
    return rows.select("episode_path", "e.task", F.unix_micros("e.last_updated").alias("updated_us"))


@R.add(
    """WITH a AS (SELECT episode_path, floor(timestamp_ms) AS k, max(row_idx) AS pose_row FROM actions_eef_pose WHERE timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) GROUP BY 1, 2),
b AS (SELECT episode_path, floor(timestamp_ms) AS k, max(row_idx) AS frame_row FROM frame_times WHERE timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) AND modality LIKE '%wrist%' GROUP BY 1, 2)
SELECT a.episode_path, CAST(k AS BIGINT) AS ms, pose_row, frame_row FROM a JOIN b USING (episode_path, k)"""
)
def exact_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two streams at the same whole millisecond; of repeated times the last row."""
    one = lambda df, n: df.filter(X.finite(F.col("timestamp_ms"))).groupBy("episode_path", F.floor("timestamp_ms").alias("ms")).agg(F.max("row_idx").alias(n))
    a = one(table(spark, sf_dir, "actions_eef_pose"), "pose_row")
    b = one(table(spark, sf_dir, "frame_times").filter(F.col("modality").like("%wrist%")), "frame_row")
    return a.join(b, ["episode_path", "ms"]).select("episode_path", "ms", "pose_row", "frame_row")


@R.add(
    SQL
    + """, m(name, device, rank) AS (VALUES ('umi', 'umi', 1), ('aloha', 'dual_arm', 2), ('arx5', 'dual_arm', 3), ('dual', 'dual_arm', 4), ('franka', 'single_arm', 5), ('flexiv', 'single_arm', 6), ('ur', 'single_arm', 7)),
c AS (SELECT DISTINCT task, robot, unnest(list_distinct(list_concat(string_split(coalesce(robot, ''), '_'), string_split(coalesce(task, ''), '_')))) AS token FROM ep)
SELECT c.task, c.robot, arg_min(device, rank) AS device, count(*) AS candidates FROM c JOIN m ON c.token = m.name GROUP BY 1, 2"""
)
def device_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device of each task and robot: the best ranked of several candidate names in a reference."""
    reference = spark.createDataFrame(
        [("umi", "umi", 1), ("aloha", "dual_arm", 2), ("arx5", "dual_arm", 3), ("dual", "dual_arm", 4), ("franka", "single_arm", 5), ("flexiv", "single_arm", 6), ("ur", "single_arm", 7)],
        "token string, device string, rank int",
    )
    pairs = clean_episodes(spark, sf_dir).select("task", "robot").distinct()
    blank = lambda c: F.split(F.coalesce(c, F.lit("")), "_")
    tokens = pairs.withColumn("token", F.explode(F.array_distinct(F.concat(blank("robot"), blank("task")))))
    # A reference of seven rows, given here.
    return tokens.join(F.broadcast(reference), "token").groupBy("task", "robot").agg(
        F.min_by("device", "rank").alias("device"), F.count(F.lit(1)).alias("candidates")
    )


@R.add(
    """WITH t AS (SELECT DISTINCT episode_path, first_kept_timestamp_ms AS a, last_kept_timestamp_ms AS z FROM trim_plan WHERE isfinite(first_kept_timestamp_ms)),
f AS (SELECT episode_path, modality, min(timestamp_ms) AS s, max(timestamp_ms) AS e FROM frame_times WHERE isfinite(timestamp_ms) GROUP BY 1, 2)
SELECT episode_path, modality, round(greatest(s, a), 6) AS overlap_start, round(least(e, z), 6) AS overlap_end FROM f JOIN t USING (episode_path) WHERE s <= z AND e >= a"""
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each stream's time range overlaps the kept range of its episode."""
    plan = table(spark, sf_dir, "trim_plan").select("episode_path", F.col("first_kept_timestamp_ms").alias("a"), F.col("last_kept_timestamp_ms").alias("z"))
    plan = plan.filter(X.finite(F.col("a"))).distinct()
    spans = table(spark, sf_dir, "frame_times").filter(X.finite(F.col("timestamp_ms"))).groupBy(*FRAME).agg(F.min("timestamp_ms").alias("s"), F.max("timestamp_ms").alias("e"))
    return spans.join(plan, "episode_path").filter("s <= z AND e >= a").select(
        *FRAME, F.round(F.greatest("s", "a"), 6).alias("overlap_start"), F.round(F.least("e", "z"), 6).alias("overlap_end")
    )


@R.add(
    """WITH s AS (SELECT episode_path, row_idx, min(timestamp_ms) AS t FROM state_joint_position GROUP BY 1, 2),
p AS (SELECT DISTINCT episode_path, first_kept_timestamp_ms AS a, last_kept_timestamp_ms AS z FROM trim_plan)
SELECT s.episode_path, row_idx, round(t - a, 6) AS rezeroed_ms FROM s JOIN p USING (episode_path) WHERE isfinite(t) AND t BETWEEN a AND z"""
)
def crop_and_rezero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint rows within the kept range, timed from its start."""
    plan = table(spark, sf_dir, "trim_plan").select("episode_path", F.col("first_kept_timestamp_ms").alias("a"), F.col("last_kept_timestamp_ms").alias("z")).distinct()
    rows = joints(spark, sf_dir, ()).filter(X.finite(F.col("timestamp_ms")))
    return rows.join(plan, "episode_path").filter(F.col("timestamp_ms").between(F.col("a"), F.col("z"))).select(
        "episode_path", "row_idx", F.round(F.col("timestamp_ms") - F.col("a"), 6).alias("rezeroed_ms")
    )


@R.add(
    """WITH s AS (SELECT episode_path, row_idx, min(timestamp_ms) AS t FROM state_joint_position GROUP BY 1, 2),
p AS (SELECT DISTINCT episode_path, trailing_standstill_start_ms AS a, trailing_standstill_end_ms AS z FROM trim_plan WHERE isfinite(trailing_standstill_start_ms))
SELECT s.episode_path, count(*) AS rows, count(*) FILTER (WHERE isfinite(t) AND t > a AND t <= z) AS standing_rows FROM s JOIN p USING (episode_path) GROUP BY 1"""
)
def interval_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each episode that fall within its trailing standstill."""
    plan = table(spark, sf_dir, "trim_plan").select("episode_path", F.col("trailing_standstill_start_ms").alias("a"), F.col("trailing_standstill_end_ms").alias("z"))
    plan = plan.filter(X.finite(F.col("a"))).distinct()
    t = F.col("timestamp_ms")
    inside = F.count_if(X.finite(t) & (t > F.col("a")) & (t <= F.col("z")))
    return joints(spark, sf_dir, ()).join(plan, "episode_path").groupBy("episode_path").agg(F.count(F.lit(1)).alias("rows"), inside.alias("standing_rows"))


@R.add(
    """WITH f AS (SELECT episode_path, modality, CAST(floor(timestamp_ms / 1000) AS BIGINT) AS sec, count(*) AS n FROM (SELECT DISTINCT episode_path, modality, row_idx, timestamp_ms FROM frame_times WHERE isfinite(timestamp_ms) AND abs(timestamp_ms) < 1e12) GROUP BY 1, 2, 3)
SELECT a.episode_path, a.modality AS stream_a, b.modality AS stream_b, count(*) AS seconds, round(avg(a.n - b.n), 6) AS mean_difference, max(abs(a.n - b.n)) AS largest_difference
FROM f a JOIN f b ON a.episode_path = b.episode_path AND a.sec = b.sec AND a.modality < b.modality GROUP BY 1, 2, 3"""
)
def peer_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame rates of an episode's streams against one another, second by second.

    Rows are first counted a second, so a pair meets one row a second and stream.
    """
    seconds = (
        frames(spark, sf_dir)
        .filter(X.finite(F.col("timestamp_ms")) & (F.abs("timestamp_ms") < 1e12))
        .groupBy(*FRAME, F.floor(F.col("timestamp_ms") / 1000).alias("sec"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    a = seconds.select("episode_path", "sec", F.col("modality").alias("stream_a"), F.col("n").alias("na"))
    b = seconds.select("episode_path", "sec", F.col("modality").alias("stream_b"), F.col("n").alias("nb"))
    d = F.col("na") - F.col("nb")
    return a.join(b, ["episode_path", "sec"]).filter("stream_a < stream_b").groupBy("episode_path", "stream_a", "stream_b").agg(
        F.count(F.lit(1)).alias("seconds"), F.round(F.avg(d), 6).alias("mean_difference"), F.max(F.abs(d)).alias("largest_difference")
    )


@R.add(
    SQL
    + r""", x AS (SELECT episode_path, task, robot, string_split(episode_path, '/') AS parts FROM ep)
SELECT episode_path, 'episode_folder_name' AS check_name, 'major' AS severity, 'fail' AS status FROM x WHERE NOT starts_with(parts[-1], 'episode_')
UNION ALL SELECT episode_path, 'parent_path_structure', 'minor', 'warning' FROM x WHERE NOT coalesce(regexp_full_match(parts[-3], '\d{8}'), false)
UNION ALL SELECT episode_path, 'required_metadata_field', 'major', 'fail' FROM x WHERE task IS NULL OR robot IS NULL
UNION ALL SELECT episode_path, 'task_folder_metadata_mismatch', 'info', 'pass' FROM x WHERE task IS NOT NULL AND NOT list_contains(list_transform(parts, lambda y: trim(lower(regexp_replace(y, '[^\p{L}\p{N}]+', '_', 'g')), '_')), task)"""
)
def check_phase1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the path and required-field checks, in one pass."""
    parts = F.split("episode_path", "/")
    tidied = F.transform(parts, lambda y: F.regexp_replace(F.regexp_replace(F.lower(y), r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", ""))
    dated = F.coalesce(F.try_element_at(parts, F.lit(-3)).rlike(r"^\d{8}$"), F.lit(False))
    rules = [
        ("episode_folder_name", "major", "fail", ~F.element_at(parts, -1).startswith("episode_")),
        ("parent_path_structure", "minor", "warning", ~dated),
        ("required_metadata_field", "major", "fail", F.col("task").isNull() | F.col("robot").isNull()),
        ("task_folder_metadata_mismatch", "info", "pass", F.col("task").isNotNull() & ~F.array_contains(tidied, F.col("task"))),
    ]
    return emit(clean_episodes(spark, sf_dir), rules)


def emit(rows: DataFrame, rules: list, key: str = "episode_path") -> DataFrame:
    """One finding row for each rule that holds; a single scan for all rules."""
    made = F.array(*[F.when(F.coalesce(hit, F.lit(False)), F.struct(F.lit(c).alias("check_name"), F.lit(v).alias("severity"), F.lit(s).alias("status"))) for c, v, s, hit in rules])
    return rows.select(key, F.inline(F.array_compact(made)))


_D, _FPS, _N = metric("p2_duration_seconds"), metric("p2_fps"), metric("p2_total_frames")


@R.add(
    SQL
    + f""", x AS (SELECT episode_path, {_D} AS d, {_FPS} AS fps, {_N} AS n FROM ep)
SELECT episode_path, 'duration_not_positive' AS check_name, 'critical' AS severity, 'fail' AS status FROM x WHERE d IS NULL OR d <= 0
UNION ALL SELECT episode_path, 'duration_under_5s', 'critical', 'fail' FROM x WHERE d > 0 AND d < 5
UNION ALL SELECT episode_path, 'total_frames_not_positive', 'critical', 'fail' FROM x WHERE n IS NULL OR n <= 0
UNION ALL SELECT episode_path, 'duration_frames_fps_inconsistent', 'major', 'fail' FROM x WHERE fps > 0 AND n > 0 AND d > 0 AND abs(d - n / fps) / (n / fps) > 0.1"""
)
def check_phase2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the duration checks."""
    number = lambda m: X.json_number(F.col("metrics"), m)
    rows = clean_episodes(spark, sf_dir).select("episode_path", number("p2_duration_seconds").alias("d"), number("p2_fps").alias("fps"), number("p2_total_frames").alias("n"))
    d, n, fps = F.col("d"), F.col("n"), F.col("fps")
    expected = F.when((fps > 0) & (n > 0), n / fps)
    rules = [
        ("duration_not_positive", "critical", "fail", d.isNull() | (d <= 0)),
        ("duration_under_5s", "critical", "fail", (d > 0) & (d < 5)),
        ("total_frames_not_positive", "critical", "fail", n.isNull() | (n <= 0)),
        ("duration_frames_fps_inconsistent", "major", "fail", (d > 0) & (X.error_ratio(d, expected) > 0.1)),
    ]
    return emit(rows, rules)


@R.add(
    SQL
    + f""", c AS (SELECT episode_path, modality, count(*) AS n FROM (SELECT DISTINCT episode_path, modality, row_idx FROM frame_times) GROUP BY 1, 2),
s AS (SELECT episode_path, max(n) - min(n) AS spread, arg_min(modality, (n, modality)) AS fewest, arg_max(modality, (n, modality)) AS most, max(n) AS top, min(n) AS low FROM c GROUP BY 1)
SELECT s.episode_path, spread, fewest, most, CASE WHEN spread > 10 THEN 'needs_review' WHEN spread >= 4 THEN 'warning' ELSE 'pass' END AS alignment,
  CASE WHEN spread = 0 THEN 'pass' WHEN spread <= 3 THEN 'needs_trim' ELSE 'fail' END AS align_verdict, coalesce(abs(top - x.n) / nullif(x.n, 0) > 0.1, false) AS count_mismatch
FROM s LEFT JOIN (SELECT episode_path, {_N} AS n FROM ep) x USING (episode_path)"""
)
def frame_count_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far row counts of an episode's streams lie apart, and off the stated count."""
    counts = frames(spark, sf_dir).groupBy(*FRAME).agg(F.count(F.lit(1)).alias("n"))
    by = F.struct("n", "modality")
    s = counts.groupBy("episode_path").agg(
        (F.max("n") - F.min("n")).alias("spread"), F.min_by("modality", by).alias("fewest"), F.max_by("modality", by).alias("most"), F.max("n").alias("top")
    )
    stated = clean_episodes(spark, sf_dir).select("episode_path", X.json_number(F.col("metrics"), "p2_total_frames").alias("x"))
    p = F.col("spread")
    alignment = F.when(p > 10, "needs_review").when(p >= 4, "warning").otherwise("pass")
    verdict = F.when(p == 0, "pass").when(p <= 3, "needs_trim").otherwise("fail")
    off = F.abs(F.col("top") - F.col("x")) / F.nullif(F.col("x"), F.lit(0.0))
    return s.join(stated, "episode_path", "left").select(
        "episode_path", "spread", "fewest", "most", alignment.alias("alignment"), verdict.alias("align_verdict"), F.coalesce(off > 0.1, F.lit(False)).alias("count_mismatch")
    )


@R.add(
    SQL
    + f""", x AS (SELECT episode_path, {metric("p3_left_wrist_view_drop_ratio")} AS drop_ratio, {metric("p5_standstill_total_excess_ms")} / 1000 AS excess, {_D} AS d FROM ep)
SELECT episode_path, 'frame_drop_ratio' AS check_name, 'major' AS severity, 'fail' AS status FROM x WHERE drop_ratio > 0.1
UNION ALL SELECT episode_path, 'operator_standstill_motion_too_short', 'critical', 'fail' FROM x WHERE excess > 0 AND d > 0 AND d - excess < 5
UNION ALL SELECT episode_path, 'operator_standstill_excessive', 'critical', 'fail' FROM x WHERE d > 0 AND d - excess >= 5 AND excess / d >= 0.4
UNION ALL SELECT episode_path, 'operator_standstill_excessive', 'major', 'needs_review' FROM x WHERE d > 0 AND d - excess >= 5 AND excess / d >= 0.2 AND excess / d < 0.4"""
)
def check_phase7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the drop and standstill ratio checks from metrics."""
    number = lambda m: X.json_number(F.col("metrics"), m)
    rows = clean_episodes(spark, sf_dir).select(
        "episode_path", number("p3_left_wrist_view_drop_ratio").alias("drop"), (number("p5_standstill_total_excess_ms") / 1000).alias("x"), number("p2_duration_seconds").alias("d")
    )
    x, d = F.col("x"), F.col("d")
    ratio = F.when(d > 0, x / F.nullif(d, F.lit(0.0)))
    useful = d - x >= 5
    rules = [
        ("frame_drop_ratio", "major", "fail", F.col("drop") > 0.1),
        ("operator_standstill_motion_too_short", "critical", "fail", (x > 0) & (d > 0) & ~useful),
        ("operator_standstill_excessive", "critical", "fail", useful & (ratio >= 0.4)),
        ("operator_standstill_excessive", "major", "needs_review", useful & (ratio >= 0.2) & (ratio < 0.4)),
    ]
    return emit(rows, rules)


@R.add(
    SQL
    + """, r AS (SELECT episode_path, epoch_us(last_updated) AS u, length(coalesce(metrics, '')) AS size FROM ep WHERE last_updated IS NOT NULL),
d AS (SELECT CAST(floor(u / 86400000000) AS BIGINT) AS day, count(*) AS n, sum(size) AS size FROM r GROUP BY 1),
c AS (SELECT *, sum(n) OVER w AS upto, sum(size) OVER w AS bytes, max(day) OVER () - day AS age FROM d WINDOW w AS (ORDER BY day DESC))
SELECT day, n, CAST(upto AS BIGINT) AS upto, CAST(bytes AS BIGINT) AS bytes, CASE WHEN age > 90 THEN 'remove_age' WHEN upto > 1500 THEN 'remove_count' WHEN bytes > 250000 THEN 'remove_size' ELSE 'keep' END AS plan FROM c"""
)
def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which days' results go: by age, then count, then size, newest first.

    Results are summed a day before the ordered sums, so the one ordered pass sees one row a day.
    """
    day = F.floor(F.unix_micros("last_updated") / 86_400_000_000)
    days = clean_episodes(spark, sf_dir).filter("last_updated IS NOT NULL").groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce("metrics", F.lit("")))).alias("size")
    )
    newest = Window.orderBy(F.desc("day"))
    c = days.withColumn("upto", F.sum("n").over(newest)).withColumn("bytes", F.sum("size").over(newest)).withColumn("age", F.max("day").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.col("day"))
    plan = F.when(F.col("age") > 90, "remove_age").when(F.col("upto") > 1500, "remove_count").when(F.col("bytes") > 250000, "remove_size").otherwise("keep")
    return c.select("day", "n", "upto", "bytes", plan.alias("plan"))


@R.add(
    """SELECT DISTINCT episode_path, md5(text) AS md5_hex, sha256(text) AS sha256_hex, sha1(concat_ws('|', coalesce(author, ''), coalesce(source, ''), CAST(doc_id AS VARCHAR))) AS key_hex FROM documents"""
)
def hash_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of texts and of joined keys."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "episode_path", F.md5("text").alias("md5_hex"), F.sha2("text", 256).alias("sha256_hex"),
        F.sha1(F.concat_ws("|", blank("author"), blank("source"), F.col("doc_id").cast("string"))).alias("key_hex"),
    ).distinct()


@R.add(
    r"""WITH d AS (SELECT DISTINCT task FROM episodes WHERE task IS NOT NULL)
SELECT task, array_to_string(list_filter(regexp_split_to_array(lower(task), '[^\p{L}\p{N}]+'), lambda x: x <> ''), '_') AS tokens, len(list_filter(regexp_split_to_array(lower(task), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS n FROM d"""
)
def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words task names are made of."""
    tokens = X.name_tokens(F.col("task"))
    return table(spark, sf_dir, "episodes").select("task").filter("task IS NOT NULL").distinct().select("task", F.array_join(tokens, "_").alias("tokens"), F.size(tokens).alias("n"))


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
