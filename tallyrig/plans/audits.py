"""Audits of streams and histories: motion findings row by row, standstill, calibration, failure streaks, report sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.config import DEFAULTS
from tallyrig.functions import exprs as X
from tallyrig.functions.text import is_fresh
from tallyrig.operators.ordered import CHUNK_ROWS, islands, with_last_known, with_previous
from tallyrig.operators.quantile import grouped_quantiles, grouped_ranks
from tallyrig.plans import reports, series
from tallyrig.plans.base import SQL, clean_episodes, clean_findings
from tallyrig.plans.registry import Registry
from tallyrig.plans.reports import UNKNOWN, flagged
from tallyrig.plans.series import FRAME, HAND_AXES, JOINTS, bad_streaks, joints, moving, poses
from tallyrig.session import table

R = Registry()
_M = DEFAULTS["motion"]
_FLAGGED = "coalesce(status, '') <> 'pass'"


def _graded(name: str, value: Column, subject: str) -> Column:
    """A finding if the size of ``value`` reaches one of the two bounds of ``name``."""
    warn, fail = _M["number" if name == "numeric_abs_limit" else name]
    size = F.abs(value)
    severity = F.when(size >= fail, "critical").when(size >= warn, "major")
    return F.when(
        severity.isNotNull(), F.struct(F.lit(name).alias("check_name"), F.lit(subject).alias("subject"), severity.alias("severity"), F.round(value, 5).alias("measured"))
    )


def _motion(rows: DataFrame, columns: list[str], others: list[str], kind: tuple[str, str, str], chunk_rows: int) -> DataFrame:
    """Row-level findings of one stream; ``columns`` are positions, ``others`` only numbers."""
    key = ["episode_path"]
    every = [*columns, *others]
    known = [F.when(X.finite(F.col(c)), F.col(c)).alias(c) for c in every]
    time = F.when(X.finite(F.col("timestamp_ms")), F.col("timestamp_ms").cast("long")).alias("t")
    pairs = with_last_known(rows.select(*key, "row_idx", time, *known), key, "row_idx", ["t", *columns], chunk_rows)
    gap = F.col("t") - F.col("prev_t")
    dt = F.when(gap > 0, gap / 1000.0)
    plain = lambda name, subject, hit, severity, value: F.when(
        hit, F.struct(F.lit(name).alias("check_name"), F.lit(subject).alias("subject"), severity.alias("severity"), value.cast("double").alias("measured"))
    )
    none = F.lit(None)
    made = [
        plain("timestamp_parse", "timestamp_ms", F.col("t").isNull(), F.lit("critical"), none),
        plain("timestamp_monotonic", "timestamp_ms", gap <= 0, F.lit("critical"), gap),
        plain("timestamp_gap", "timestamp_ms", gap >= _M["gap_ms"][0], F.when(gap >= _M["gap_ms"][1], "major").otherwise("minor"), gap),
    ]
    for c in every:
        made.append(plain("numeric_parse", c, F.col(c).isNull(), F.lit("critical"), none))
        made.append(_graded("numeric_abs_limit", F.col(c), c))
    for c in columns:
        step = F.col(c) - F.col(f"prev_{c}")
        made += [_graded(name, value, c) for name, value in zip(kind, (F.col(c), step, step / dt))]
    return pairs.select(*key, "row_idx", F.inline(F.array_compact(F.array(*made))))


def _motion_sql(name: str, source: str, columns: list[str], others: list[str], kind: tuple[str, str, str]) -> str:
    every = [*columns, *others]
    grade = lambda check, value, warn, fail: (
        f"SELECT episode_path, row_idx, '{check}', col, CASE WHEN abs({value}) >= {fail} THEN 'critical' ELSE 'major' END, round({value}, 5) FROM {{t}} WHERE abs({value}) >= {warn}"
    )
    steps = [grade(n, v, *_M[n]).format(t="v") for n, v in zip(kind, ("x", "step", "step / dt"))]
    return f"""SELECT '{name}' AS stream, * FROM (WITH s AS (SELECT episode_path, row_idx, CASE WHEN isfinite(min(timestamp_ms)) THEN CAST(trunc(min(timestamp_ms)) AS BIGINT) END AS t,
  {", ".join(f"CASE WHEN isfinite(min({c})) THEN min({c}) END AS {c}" for c in every)} FROM {source} WHERE episode_path IS NOT NULL AND row_idx IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, t - last_value(t IGNORE NULLS) OVER (PARTITION BY episode_path ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM s),
n AS (SELECT episode_path, row_idx, col, x, gap FROM g UNPIVOT INCLUDE NULLS (x FOR col IN ({", ".join(every)}))),
v AS (SELECT *, x - last_value(x IGNORE NULLS) OVER (PARTITION BY episode_path, col ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS step,
  CASE WHEN gap > 0 THEN gap / 1000.0 END AS dt FROM n WHERE col IN ({", ".join(f"'{c}'" for c in columns)}))
SELECT episode_path, row_idx, 'timestamp_parse' AS check_name, 'timestamp_ms' AS subject, 'critical' AS severity, NULL::DOUBLE AS measured FROM g WHERE t IS NULL
UNION ALL SELECT episode_path, row_idx, 'timestamp_monotonic', 'timestamp_ms', 'critical', gap FROM g WHERE gap <= 0
UNION ALL SELECT episode_path, row_idx, 'timestamp_gap', 'timestamp_ms', CASE WHEN gap >= 1000 THEN 'major' ELSE 'minor' END, gap FROM g WHERE gap >= 200
UNION ALL SELECT episode_path, row_idx, 'numeric_parse', col, 'critical', NULL FROM n WHERE x IS NULL
UNION ALL {grade("numeric_abs_limit", "x", *_M["number"]).format(t="n")}
UNION ALL {" UNION ALL ".join(steps)})"""


_JOINT_KIND = ("joint_position_abs", "joint_position_step", "joint_velocity_derived")
_HAND_KIND = ("eef_position_abs", "eef_position_step", "eef_velocity_derived")
_OBSERVED, _ACTED = "observation.state.joint_position", "actions.eef_pose"


@R.add(_motion_sql(_OBSERVED, "state_joint_position", JOINTS, ["gripper"], _JOINT_KIND) + " UNION ALL " + _motion_sql(_ACTED, "actions_eef_pose", HAND_AXES, [], _HAND_KIND))
def motion_findings(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Each row and column of joints and hands whose value, step or speed is beyond what is usual, and each odd time."""
    state = _motion(joints(spark, sf_dir), JOINTS, ["gripper"], _JOINT_KIND, chunk_rows).withColumn("stream", F.lit(_OBSERVED))
    hands = _motion(poses(spark, sf_dir, HAND_AXES), HAND_AXES, [], _HAND_KIND, chunk_rows).withColumn("stream", F.lit(_ACTED))
    return state.unionByName(hands)


@R.add(
    f"""WITH m AS ({R.sql["motion_findings"]}), e AS (SELECT DISTINCT episode_path FROM state_joint_position UNION SELECT episode_path FROM actions_eef_pose),
c AS (SELECT episode_path, count(*) AS findings, count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, count(*) FILTER (WHERE severity = 'minor') AS minor FROM m GROUP BY 1)
SELECT episode_path, coalesce(findings, 0) AS findings, coalesce(critical, 0) AS critical, coalesce(major, 0) AS major, coalesce(minor, 0) AS minor,
  CASE WHEN critical > 0 THEN 'fail_candidate' WHEN major > 0 THEN 'needs_review' WHEN minor > 0 THEN 'warning' ELSE 'pass' END AS status FROM e LEFT JOIN c USING (episode_path) WHERE episode_path IS NOT NULL"""
)
def motion_summary(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Each episode's motion findings by severity, and the status they suggest."""
    count = lambda s: F.count_if(F.col("severity") == s).alias(s)
    c = motion_findings(spark, sf_dir, chunk_rows).groupBy("episode_path").agg(F.count(F.lit(1)).alias("findings"), count("critical"), count("major"), count("minor"))
    paths = table(spark, sf_dir, "state_joint_position").select("episode_path").union(table(spark, sf_dir, "actions_eef_pose").select("episode_path"))
    out = paths.filter("episode_path IS NOT NULL").distinct().join(c, "episode_path", "left").na.fill(0)
    status = F.when(F.col("critical") > 0, "fail_candidate").when(F.col("major") > 0, "needs_review").when(F.col("minor") > 0, "warning").otherwise("pass")
    return out.withColumn("status", status)


_STILL = " AND ".join(f"isfinite({j}) AND abs({j} - lag({j}) OVER w) < 0.001" for j in JOINTS)


@R.add(
    series._JOINTS
    + f""", t AS (SELECT * REPLACE (CASE WHEN isfinite(timestamp_ms) THEN timestamp_ms ELSE 0.0 END AS timestamp_ms) FROM s),
d AS (SELECT *, lag(timestamp_ms) OVER w AS pt, coalesce({_STILL} AND timestamp_ms > lag(timestamp_ms) OVER w, false) AS still FROM t WINDOW w AS (PARTITION BY episode_path ORDER BY row_idx)),
i AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY episode_path ORDER BY row_idx) AS island FROM d)
SELECT episode_path, min(pt) AS stop_start_ms, max(timestamp_ms) AS stop_end_ms, round(max(timestamp_ms) - min(pt), 6) AS duration_ms, min(pt) + 5000 AS annotate_start_ms
FROM i WHERE still GROUP BY episode_path, island HAVING max(timestamp_ms) - min(pt) > 5000"""
)
def standstill_in_state(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Idling of more than five seconds between successive rows as they were recorded, backward times breaking it.

    Unlike ``stillness_segments`` no row is dropped first; a missing time counts as zero.
    """
    t = F.when(X.finite(F.col("timestamp_ms")), F.col("timestamp_ms")).otherwise(0.0)
    known = [F.when(X.finite(F.col(j)), F.col(j)).alias(j) for j in JOINTS]
    key = ["episode_path"]
    pairs = with_previous(joints(spark, sf_dir).select(*key, "row_idx", t.alias("t"), *known), key, "row_idx", ["t", *JOINTS], chunk_rows)
    opens = moving() | ~F.coalesce(F.col("t") > F.col("prev_t"), F.lit(False))
    marked = pairs.select(*key, "row_idx", "t", "prev_t", opens.alias("opens"))
    runs = islands(marked, key, "row_idx", F.col("opens"), chunk_rows).filter("NOT opens").groupBy(*key, "island").agg(F.min("prev_t").alias("a"), F.max("t").alias("z"))
    buffer = DEFAULTS["phase7"]["warn_ms"]
    return runs.filter(F.col("z") - F.col("a") > buffer).select(
        *key, F.col("a").alias("stop_start_ms"), F.col("z").alias("stop_end_ms"), F.round(F.col("z") - F.col("a"), 6).alias("duration_ms"), (F.col("a") + buffer).alias("annotate_start_ms")
    )


_XYZ = DEFAULTS["action"]["xyz_abs"]


@R.add(
    "WITH p AS (SELECT episode_path, row_idx, " + ", ".join(f"min({c}) AS {c}" for c in HAND_AXES) + " FROM actions_eef_pose GROUP BY ALL), u AS (SELECT * FROM p UNPIVOT INCLUDE NULLS (x FOR col IN ("
    + ", ".join(HAND_AXES)
    + f""")))
SELECT episode_path, count(DISTINCT row_idx) AS rows, count(*) FILTER (WHERE x IS NULL OR NOT isfinite(x)) AS non_finite, count(*) FILTER (WHERE isfinite(x) AND abs(x) > {_XYZ}) AS outliers,
  min(row_idx) FILTER (WHERE isfinite(x) AND abs(x) > {_XYZ}) AS first_outlier_row,
  concat_ws(';', CASE WHEN count(*) FILTER (WHERE x IS NULL OR NOT isfinite(x)) > 0 THEN 'non_finite_xyz' END, CASE WHEN count(*) FILTER (WHERE isfinite(x) AND abs(x) > {_XYZ}) > 0 THEN 'xyz_abs_outlier' END) AS problems FROM u GROUP BY 1"""
)
def action_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand positions that are no number or further from the origin than an arm reaches, an episode."""
    rows = poses(spark, sf_dir, HAND_AXES)
    lost = sum((F.when(X.finite(F.col(c)), 0).otherwise(1) for c in HAND_AXES), F.lit(0))
    far = sum((F.when(X.finite(F.col(c)) & (F.abs(c) > _XYZ), 1).otherwise(0) for c in HAND_AXES), F.lit(0))
    out = rows.select("episode_path", "row_idx", lost.alias("lost"), far.alias("far")).groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("lost").alias("non_finite"), F.sum("far").alias("outliers"), F.min(F.when(F.col("far") > 0, F.col("row_idx"))).alias("first_outlier_row")
    )
    problems = F.concat_ws(";", F.when(F.col("non_finite") > 0, "non_finite_xyz"), F.when(F.col("outliers") > 0, "xyz_abs_outlier"))
    return out.withColumn("problems", problems)


@R.add(
    f"""WITH m AS ({series.R.sql["monotonic_violations"]}), g AS ({series.R.sql["missing_inferred"]})
SELECT episode_path, modality, n, violations, duplicates, coalesce(missing_frames, 0) AS missing_frames,
  concat_ws(';', CASE WHEN violations > 0 THEN 'nonmonotonic_timestamps' END, CASE WHEN duplicates > 0 THEN 'duplicate_timestamps' END, CASE WHEN missing_frames > 0 THEN 'missing_frames' END) AS problems
FROM m LEFT JOIN g USING (episode_path, modality)"""
)
def stream_problems(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS, chunk_ms: int = 300_000) -> DataFrame:
    """What is wrong with the times of each image stream, as a list."""
    order = series.monotonic_violations(spark, sf_dir, chunk_rows).select(*FRAME, "n", "violations", "duplicates")
    gone = series.missing_inferred(spark, sf_dir, chunk_ms).select(*FRAME, "missing_frames")
    missing = F.coalesce("missing_frames", F.lit(0))
    problems = F.concat_ws(
        ";", F.when(F.col("violations") > 0, "nonmonotonic_timestamps"), F.when(F.col("duplicates") > 0, "duplicate_timestamps"), F.when(missing > 0, "missing_frames")
    )
    return order.join(gone, FRAME, "left").select(*FRAME, "n", "violations", "duplicates", missing.alias("missing_frames"), problems.alias("problems"))


@R.add(
    rf"""WITH u AS (SELECT DISTINCT episode_path, modality, timestamp_ms AS t FROM frame_times WHERE timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) AND {series._FRESH}),
g AS (SELECT episode_path, modality, t - lag(t) OVER (PARTITION BY episode_path, modality ORDER BY t) AS d FROM u),
l AS (SELECT episode_path, modality, list_sort(list(d) FILTER (WHERE d > 0)) AS ds FROM g GROUP BY 1, 2)
SELECT episode_path, modality, round(coalesce(ds[len(ds) // 2 + 1], 33.333333), 6) AS frame_delta_ms FROM l"""
)
def frame_delta(spark: SparkSession, sf_dir: str, chunk_ms: int = 300_000) -> DataFrame:
    """The upper median of each stream's steps in time; 33.333333 where there are none."""
    rows = table(spark, sf_dir, "frame_times").filter(
        is_fresh(F.col("is_new"), F.col("timestamp_ms")) & X.finite(F.col("timestamp_ms")) & F.col("episode_path").isNotNull() & F.col("modality").isNotNull()
    )
    times = rows.select(*FRAME, F.col("timestamp_ms").alias("t")).distinct()
    steps = with_previous(times, FRAME, "t", ["t"], chunk_ms).select(*FRAME, (F.col("t") - F.col("prev_t")).alias("d")).filter("d > 0")
    middle = grouped_ranks(steps, FRAME, "d", lambda n: {"at": F.floor(n / 2)})
    streams = times.select(*FRAME).distinct()
    return streams.join(middle, FRAME, "left").select(*FRAME, F.round(F.coalesce("at", F.lit(33.333333)), 6).alias("frame_delta_ms"))


@R.add(
    SQL.rstrip()
    + f""", s AS (SELECT episode_path, row_idx, {", ".join(f"min({c}) AS {c}" for c in (*JOINTS, "gripper"))} FROM state_joint_position GROUP BY ALL),
u AS (SELECT episode_path, row_idx, CASE col WHEN 'gripper' THEN 'gripper' ELSE 'joint' END AS kind, x, abs(x - lag(x) OVER (PARTITION BY episode_path, col ORDER BY row_idx)) AS step
  FROM (SELECT * FROM (UNPIVOT s ON {", ".join((*JOINTS, "gripper"))} INTO NAME col VALUE x) WHERE isfinite(x))),
a AS (SELECT coalesce(robot, '{UNKNOWN}') AS robot, kind, x, step FROM u JOIN ep USING (episode_path) WHERE final_status = 'pass'),
v AS (SELECT robot, kind || '_position' AS metric, x AS v FROM a UNION ALL SELECT robot, kind || '_step', step FROM a WHERE step IS NOT NULL)
SELECT robot, metric, count(*) AS n, round(quantile_cont(v, 0.001), 6) AS low, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.999), 6) AS high, round(1.2 * quantile_cont(v, 0.999), 6) AS suggested_limit FROM v GROUP BY 1, 2"""
)
def calibration_streams(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Spread of joint and gripper positions and steps of each robot over episodes that passed, and a limit to use."""
    key, columns = ["episode_path"], [*JOINTS, "gripper"]
    good = clean_episodes(spark, sf_dir).filter(F.col("final_status") == "pass").select("episode_path", F.coalesce("robot", F.lit(UNKNOWN)).alias("robot"))
    rows = joints(spark, sf_dir).join(good, "episode_path")
    known = [F.when(X.finite(F.col(c)), F.col(c)).alias(c) for c in columns]
    pairs = with_last_known(rows.select(*key, "robot", "row_idx", *known), key, "row_idx", columns, chunk_rows)
    made = []
    for c in columns:
        kind = "gripper" if c == "gripper" else "joint"
        made += [F.struct(F.lit(f"{kind}_position").alias("metric"), F.col(c).alias("v")), F.struct(F.lit(f"{kind}_step").alias("metric"), F.abs(F.col(c) - F.col(f"prev_{c}")).alias("v"))]
    values = pairs.select("robot", F.inline(F.array(*made))).filter("v IS NOT NULL")
    out = grouped_quantiles(values, ["robot", "metric"], "v", {"low": 0.001, "median": 0.5, "high": 0.999})
    return out.select("robot", "metric", "n", F.round("low", 6).alias("low"), F.round("median", 6).alias("median"), F.round("high", 6).alias("high"), F.round(F.col("high") * 1.2, 6).alias("suggested_limit"))


_SHOWN = DEFAULTS["streak"]["shown"]


@R.add(
    SQL
    + rf""", e AS (SELECT coalesce(task, '{UNKNOWN}') AS task, coalesce(robot, '{UNKNOWN}') AS robot, coalesce(operator, '{UNKNOWN}') AS operator,
  try_cast(nullif(regexp_extract(episode_path, 'episode_(\d+)(?:_|$)', 1), '') AS INT) AS number, final_status IN ('fail', 'needs_review') AS bad, last_updated FROM ep),
b AS (SELECT task, robot, operator, number, epoch_us(max(last_updated)) AS seen FROM e WHERE bad AND number IS NOT NULL GROUP BY ALL),
x AS (SELECT *, number - row_number() OVER (PARTITION BY task, robot, operator ORDER BY number) AS g FROM b),
s AS (SELECT task, robot, operator, min(number) AS episode_start, max(number) AS episode_end, count(*) AS streak_length, max(seen) AS detected_us FROM x GROUP BY task, robot, operator, g HAVING count(*) >= 2),
n AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY task, robot, operator ORDER BY detected_us DESC NULLS LAST, episode_end DESC) = 1)
SELECT *, (SELECT count(*) FROM n) AS combinations, greatest((SELECT count(*) FROM n) - {_SHOWN}, 0) AS hidden FROM n ORDER BY detected_us DESC NULLS LAST, task, robot, operator LIMIT {_SHOWN}"""
)
def streak_warnings(spark: SparkSession, sf_dir: str, least: int = 2, shown: int = _SHOWN, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The newest run of failed episodes of each task, robot and operator: the twenty newest, and how many are not shown.

    ``least`` is the shortest run that warns; services watch for ``streak.length`` of the settings.
    """
    keys = ["task", "robot", "operator"]
    number = F.regexp_extract("episode_path", r"episode_(\d+)(?:_|$)", 1).try_cast("int")
    bad = clean_episodes(spark, sf_dir).filter(F.col("final_status").isin("fail", "needs_review"))
    bad = bad.select(*[F.coalesce(k, F.lit(UNKNOWN)).alias(k) for k in keys], number.alias("number"), F.unix_micros("last_updated").alias("seen")).filter("number IS NOT NULL")
    seen = bad.groupBy(*keys, "number").agg(F.max("seen").alias("seen"))
    # A group's streaks are few, so each failed episode finds its own by a join on the group.
    streaks = bad_streaks(seen.select(*keys, "number"), keys, least, chunk_rows)
    inside = seen.join(streaks, keys).filter(F.col("number").between(F.col("episode_start"), F.col("episode_end")))
    dated = inside.groupBy(*keys, "episode_start", "episode_end", "streak_length").agg(F.max("seen").alias("detected_us"))
    newest = dated.groupBy(*keys).agg(F.max(F.struct("detected_us", "episode_end", "episode_start", "streak_length")).alias("s"))
    total = newest.agg(F.count(F.lit(1)).alias("combinations"))
    rows = newest.select(*keys, "s.episode_start", "s.episode_end", "s.streak_length", "s.detected_us")
    # One row of totals.
    out = rows.join(F.broadcast(total), F.lit(True)).withColumn("hidden", F.greatest(F.col("combinations") - shown, F.lit(0)))
    return out.orderBy(F.desc_nulls_last("detected_us"), *keys).limit(shown)


_KINDS = ("fail", "needs_review", "warning", "pass", "pending")
_LEVELS = ("critical", "major", "minor", "info")


@R.add(
    SQL
    + f""", e AS (SELECT coalesce(final_status, 'pending') AS s FROM ep), f AS (SELECT severity FROM fd WHERE {_FLAGGED})
SELECT 'episodes' AS metric, count(*) AS value FROM e UNION ALL SELECT 'non_pass_findings', count(*) FROM f UNION ALL """
    + " UNION ALL ".join(f"SELECT 'episodes_{k}', count(*) FILTER (WHERE s = '{k}') FROM e" for k in _KINDS)
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT 'findings_{k}', count(*) FILTER (WHERE severity = '{k}') FROM f" for k in _LEVELS)
)
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a report: episodes by status and open findings by severity."""
    status = F.coalesce("final_status", F.lit("pending"))
    e = clean_episodes(spark, sf_dir).agg(F.count(F.lit(1)).alias("episodes"), *[F.count_if(status == k).alias(f"episodes_{k}") for k in _KINDS])
    f = flagged(clean_findings(spark, sf_dir)).agg(F.count(F.lit(1)).alias("non_pass_findings"), *[F.count_if(F.col("severity") == k).alias(f"findings_{k}") for k in _LEVELS])
    tall = lambda df: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in df.columns])))
    return tall(e).unionByName(tall(f))


@R.add(SQL + f"SELECT coalesce(check_name, '{UNKNOWN}') AS check_name, count(*) AS count FROM fd WHERE {_FLAGGED} GROUP BY 1")
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open findings a check."""
    return flagged(clean_findings(spark, sf_dir)).groupBy(F.coalesce("check_name", F.lit(UNKNOWN)).alias("check_name")).count()


def workbook_sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five sheets of the workbook, for ``sources.reports.write_sheets``."""
    return {
        "summary": report_summary(spark, sf_dir),
        "tasks": reports.status_pivot_by_task(spark, sf_dir).orderBy("task"),
        "issues": issue_counts(spark, sf_dir).orderBy(F.desc("count"), "check_name"),
        "episodes": reports.quality_report_rows(spark, sf_dir).orderBy("episode_path"),
        "findings": flagged(reports.findings_enriched(spark, sf_dir)).orderBy("id"),
    }


def summary_sections(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven sections of the Markdown summary, for ``sources.reports.markdown``."""
    return {
        "Overview": report_summary(spark, sf_dir),
        "Status by Task": reports.status_pivot_by_task(spark, sf_dir).orderBy("task"),
        "Status by Operator": reports.status_pivot_by_operator(spark, sf_dir).orderBy("operator"),
        "Status by Robot": reports.status_pivot_by_robot(spark, sf_dir).orderBy("robot"),
        "Top Issues": reports.top_checks_distinct(spark, sf_dir),
        "Flagged Groups": reports.flagged_rate_top_issues(spark, sf_dir).orderBy("task", "date", "operator"),
        "Duration by Robot": reports.duration_by_robot(spark, sf_dir).orderBy("robot"),
    }


def session_report(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of a work-session report: totals, core issues, operators, affected episodes, groups, parts of the day."""
    return {
        "totals": report_summary(spark, sf_dir),
        "core_issues": reports.core_issues(spark, sf_dir).orderBy(F.desc("priority"), "check_name"),
        "operators": reports.operator_rollup(spark, sf_dir).orderBy("operator"),
        "affected_episodes": reports.affected_episodes(spark, sf_dir).orderBy("episode_path", "check_name"),
        "issue_groups": reports.issue_groups(spark, sf_dir),
        "warnings": streak_warnings(spark, sf_dir),
    }


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
