"""Report queries over episodes and findings: counts, pivots, rollups, rankings, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrig.config import DEFAULTS
from tallyrig.functions import exprs as X
from tallyrig.operators.quantile import average_ranks, grouped_quantiles, grouped_ranks
from tallyrig.plans.base import SQL, clean_episodes, clean_findings, metric
from tallyrig.plans.registry import Registry
from tallyrig.session import table

R = Registry()
UNKNOWN = "(unknown)"
#: Pivoted statuses, in report order.
PIVOT = ("pass", "warning", "needs_review", "fail", "umi_pending")
#: Weight of a severity in the priority of an issue; others have the last.
WEIGHTS = {k: v for k, v in DEFAULTS["severity_weight"].items() if k != "other"}
OTHER_WEIGHT = DEFAULTS["severity_weight"]["other"]
_PENDING = "coalesce(final_status, 'pending')"
_RANK = "CASE severity WHEN 'critical' THEN 3 WHEN 'major' THEN 2 WHEN 'minor' THEN 1 WHEN 'info' THEN 0 ELSE -1 END"


def _known(name: str):
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


def flagged(findings: DataFrame) -> DataFrame:
    """Findings that report something (a null status does)."""
    return findings.filter(F.coalesce(F.col("status"), F.lit("")) != "pass")


def _status_pivot(episodes: DataFrame, key: str) -> DataFrame:
    counts = [F.count_if(F.col("final_status") == s).alias(f"n_{s}") for s in PIVOT]
    pending = F.count_if(F.col("final_status").isNull()).alias("n_pending")
    return episodes.groupBy(_known(key).alias(key)).agg(F.count(F.lit(1)).alias("episodes"), *counts, pending)


def _status_pivot_sql(key: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE final_status = '{s}') AS n_{s}" for s in PIVOT)
    return SQL + (
        f"SELECT coalesce({key}, '{UNKNOWN}') AS {key}, count(*) AS episodes, {counts}, "
        f"count(*) FILTER (WHERE final_status IS NULL) AS n_pending FROM ep GROUP BY 1"
    )


@R.add(_status_pivot_sql("task"))
def status_pivot_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_pivot(clean_episodes(spark, sf_dir), "task")


@R.add(_status_pivot_sql("robot"))
def status_pivot_by_robot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_pivot(clean_episodes(spark, sf_dir), "robot")


@R.add(_status_pivot_sql("operator"))
def status_pivot_by_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_pivot(clean_episodes(spark, sf_dir), "operator")


@R.add(
    SQL
    + f""", g AS (SELECT coalesce(task, '{UNKNOWN}') AS task, date, coalesce(operator, '{UNKNOWN}') AS operator,
  count(*) AS episodes, count(*) FILTER (WHERE final_status IN ('fail', 'needs_review')) AS flagged
  FROM ep WHERE date IS NOT NULL GROUP BY 1, 2, 3 HAVING flagged / episodes >= 0.3),
i AS (SELECT coalesce(task, '{UNKNOWN}') AS task, date, coalesce(operator, '{UNKNOWN}') AS operator, check_name, count(*) AS n
  FROM fd JOIN ep USING (episode_path) WHERE coalesce(status, '') <> 'pass' AND check_name IS NOT NULL GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY task, date, operator ORDER BY n DESC, check_name) AS k FROM i),
t AS (SELECT task, date, operator, string_agg(check_name || '(' || n || ')', '; ' ORDER BY k) AS top_issues FROM r WHERE k <= 3 GROUP BY 1, 2, 3)
SELECT task, date, operator, episodes, flagged, round(flagged / episodes, 6) AS flagged_rate, coalesce(top_issues, '') AS top_issues
FROM g LEFT JOIN t USING (task, date, operator)"""
)
def flagged_rate_top_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of task, date and operator with 30 % flagged episodes or more, and their three main issues."""
    keys = ["task", "date", "operator"]
    episodes = clean_episodes(spark, sf_dir).filter(F.col("date").isNotNull())
    episodes = episodes.select("episode_path", _known("task").alias("task"), "date", _known("operator").alias("operator"), "final_status")
    groups = (
        episodes.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("final_status").isin("fail", "needs_review")).alias("flagged"))
        .withColumn("rate", F.col("flagged") / F.col("episodes"))
        .filter("rate >= 0.3")
    )
    issues = (
        flagged(clean_findings(spark, sf_dir))
        .filter(F.col("check_name").isNotNull())
        .groupBy("episode_path", "check_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(episodes, "episode_path")
        .groupBy(*keys, "check_name")
        .agg(F.sum("n").alias("n"))
    )
    top = issues.withColumn(
        "k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "check_name"))
    ).filter("k <= 3")
    text = top.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("k", F.concat("check_name", F.lit("("), "n", F.lit(")")).alias("t")))).alias("a")
    )
    text = text.select(*keys, F.array_join("a.t", "; ").alias("top_issues"))
    return groups.join(text, keys, "left").select(
        *keys, "episodes", "flagged", F.round("rate", 6).alias("flagged_rate"), F.coalesce("top_issues", F.lit("")).alias("top_issues")
    )


@R.add(
    SQL
    + """SELECT check_name, count(*) AS findings, count(DISTINCT episode_path) AS episodes FROM fd
WHERE coalesce(status, '') <> 'pass' GROUP BY 1 ORDER BY episodes DESC, findings DESC, check_name LIMIT 10"""
)
def top_checks_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten checks that affect most episodes, counted exactly."""
    out = flagged(clean_findings(spark, sf_dir)).groupBy("check_name").agg(
        F.count(F.lit(1)).alias("findings"), F.count_distinct("episode_path").alias("episodes")
    )
    return out.orderBy(F.desc("episodes"), F.desc("findings"), "check_name").limit(10)


@R.add(
    SQL
    + f""", s AS (SELECT episode_path, array_to_string(list_sort(list(DISTINCT check_name)), ';') AS issues, max({_RANK}) AS rank,
  count(*) AS n FROM fd WHERE coalesce(status, '') <> 'pass' GROUP BY 1)
SELECT episode_path, task, date, operator, robot, controller, {_PENDING} AS final_status, training_ready,
  coalesce(issues, '') AS issues, coalesce(n, 0) AS issue_count,
  CASE rank WHEN 3 THEN 'critical' WHEN 2 THEN 'major' WHEN 1 THEN 'minor' WHEN 0 THEN 'info' ELSE '' END AS max_severity
FROM ep LEFT JOIN s USING (episode_path)"""
)
def quality_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report row an episode: its different issues and the worst severity."""
    states = flagged(clean_findings(spark, sf_dir)).groupBy("episode_path").agg(
        F.array_join(F.sort_array(F.collect_set("check_name")), ";").alias("issues"),
        F.max(X.severity_rank(F.col("severity"))).alias("rank"),
        F.count(F.lit(1)).alias("n"),
    )
    return clean_episodes(spark, sf_dir).join(states, "episode_path", "left").select(
        "episode_path", "task", "date", "operator", "robot", "controller",
        F.coalesce("final_status", F.lit("pending")).alias("final_status"), "training_ready",
        F.coalesce("issues", F.lit("")).alias("issues"), F.coalesce("n", F.lit(0)).alias("issue_count"),
        F.coalesce(F.try_element_at(F.array(*[F.lit(s) for s in X.SEVERITIES]), F.when(F.col("rank") >= 0, F.col("rank") + 1)), F.lit("")).alias("max_severity"),
    )


@R.add(
    SQL
    + """SELECT fd.id, fd.episode_path, phase, check_name, severity, status, task, robot, operator
FROM fd LEFT JOIN ep USING (episode_path)"""
)
def findings_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with their episode's names; those without an episode stay."""
    names = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot", "operator")
    return clean_findings(spark, sf_dir).drop("message", "details").join(names, "episode_path", "left")


@R.add(
    SQL
    + """SELECT episode_path, phase, CASE WHEN bool_or(severity = 'critical') THEN 'fail'
  WHEN bool_or(severity = 'major' AND status = 'fail') THEN 'fail' WHEN bool_or(status = 'needs_review') THEN 'needs_review'
  WHEN bool_or(severity IN ('major', 'minor')) THEN 'warning' ELSE 'pass' END AS decided, count(*) AS findings FROM fd GROUP BY 1, 2"""
)
def decide_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of each episode and phase from its findings."""
    decided = X.decide_status(F.col("severity"), F.col("status"))
    return clean_findings(spark, sf_dir).groupBy("episode_path", "phase").agg(
        decided.alias("decided"), F.count(F.lit(1)).alias("findings")
    )


@R.add(
    SQL
    + """SELECT episode_path, CASE WHEN list_contains(map_values(phase_status), 'pending') THEN 'umi_pending'
  WHEN list_contains(map_values(phase_status), 'fail') THEN 'fail' WHEN list_contains(map_values(phase_status), 'needs_review') THEN 'needs_review'
  WHEN list_contains(map_values(phase_status), 'warning') THEN 'warning' ELSE 'pass' END AS verdict FROM ep"""
)
def final_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_episodes(spark, sf_dir).select("episode_path", X.final_verdict(F.col("phase_status")).alias("verdict"))


@R.add(
    SQL
    + f"""SELECT episode_path, arg_max(severity, {_RANK}) AS max_severity, max({_RANK}) AS severity_rank,
  max(CASE status WHEN 'fail' THEN 3 WHEN 'needs_review' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS status_rank
FROM fd WHERE severity IS NOT NULL GROUP BY 1"""
)
def max_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst severity and status of each episode by their own orders."""
    rank = X.severity_rank(F.col("severity"))
    status = F.greatest(F.lit(0), X.severity_rank(F.col("status"), ("pass", "warning", "needs_review", "fail")))
    return clean_findings(spark, sf_dir).filter(F.col("severity").isNotNull()).groupBy("episode_path").agg(
        F.max_by("severity", rank).alias("max_severity"), F.max(rank).alias("severity_rank"), F.max(status).alias("status_rank")
    )


@R.add(
    SQL
    + f"""SELECT 'final_status' AS kind, {_PENDING} AS name, count(*) AS n FROM ep GROUP BY 2
UNION ALL SELECT 'severity', coalesce(severity, '{UNKNOWN}'), count(*) FROM fd GROUP BY 2
UNION ALL SELECT 'status', coalesce(status, '{UNKNOWN}'), count(*) FROM fd GROUP BY 2
UNION ALL SELECT 'phase', coalesce(CAST(phase AS VARCHAR), '{UNKNOWN}'), count(*) FROM fd GROUP BY 2"""
)
def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by final status, severity, status and phase; one pass over each table."""
    final = clean_episodes(spark, sf_dir).groupBy(F.coalesce("final_status", F.lit("pending")).alias("name")).count()
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(k).cast("string"), F.lit(UNKNOWN)).alias("name")) for k in ("severity", "status", "phase")])
    others = clean_findings(spark, sf_dir).select(F.inline(pairs)).groupBy("kind", "name").count()
    final = final.select(F.lit("final_status").alias("kind"), "name", F.col("count").alias("n"))
    return final.unionByName(others.withColumnRenamed("count", "n"))


_DURATION = metric("p2_duration_seconds")


@R.add(
    SQL
    + f"""SELECT coalesce(robot, '{UNKNOWN}') AS robot, round(sum(d), 3) AS total_seconds, count(d) AS episodes,
  count(*) AS all_episodes FROM (SELECT robot, CASE WHEN {_DURATION} > 0 THEN {_DURATION} END AS d FROM ep) GROUP BY 1"""
)
def duration_by_robot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded time of each robot from the usable durations."""
    duration = X.positive(X.json_number(F.col("metrics"), "p2_duration_seconds"))
    out = clean_episodes(spark, sf_dir).select(_known("robot").alias("robot"), duration.alias("d"))
    return out.groupBy("robot").agg(
        F.round(F.sum("d"), 3).alias("total_seconds"), F.count("d").alias("episodes"), F.count(F.lit(1)).alias("all_episodes")
    )


_W = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items())


@R.add(
    SQL
    + f""", t AS (SELECT count(*) AS all_episodes FROM ep), f AS (SELECT * FROM fd WHERE coalesce(status, '') <> 'pass'),
n AS (SELECT count(*) AS all_findings, count(DISTINCT episode_path) AS bad_episodes FROM f)
SELECT check_name, count(*) AS findings, count(DISTINCT f.episode_path) AS episodes, count(DISTINCT task) AS tasks,
  count(DISTINCT robot) AS robots, count(DISTINCT operator) AS operators,
  round(100.0 * count(*) / any_value(all_findings), 4) AS pct_findings,
  round(100.0 * count(DISTINCT f.episode_path) / any_value(bad_episodes), 4) AS pct_bad_episodes,
  round(100.0 * count(DISTINCT f.episode_path) / any_value(all_episodes), 4) AS pct_all_episodes,
  max(CASE severity {_W} ELSE {OTHER_WEIGHT} END) + 3 * count(DISTINCT f.episode_path) + count(*) AS priority
FROM f LEFT JOIN ep USING (episode_path), t, n GROUP BY 1"""
)
def core_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each issue's reach and priority.

    Findings are reduced to one row an episode and check before the join, so
    distinct counts run over compact states.
    """
    weight = F.lit(OTHER_WEIGHT)
    for name, value in WEIGHTS.items():
        weight = F.when(F.col("severity") == name, value).otherwise(weight)
    states = flagged(clean_findings(spark, sf_dir)).groupBy("check_name", "episode_path").agg(
        F.count(F.lit(1)).alias("n"), F.max(weight).alias("w")
    )
    episodes = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot", "operator")
    joined = states.join(episodes, "episode_path", "left")
    out = joined.groupBy("check_name").agg(
        F.sum("n").alias("findings"),
        F.count("episode_path").alias("episodes"),
        F.count_distinct("task").alias("tasks"),
        F.count_distinct("robot").alias("robots"),
        F.count_distinct("operator").alias("operators"),
        F.max("w").alias("w"),
    )
    # One row each: totals to relate to.
    totals = states.agg(F.sum("n").alias("all_findings"), F.count_distinct("episode_path").alias("bad")).join(
        F.broadcast(episodes.agg(F.count(F.lit(1)).alias("all_episodes"))), F.lit(True)
    )
    share = lambda a, b: F.round(F.col(a) * 100.0 / F.col(b), 4)
    return out.join(F.broadcast(totals), F.lit(True)).select(
        "check_name", "findings", "episodes", "tasks", "robots", "operators",
        share("findings", "all_findings").alias("pct_findings"),
        share("episodes", "bad").alias("pct_bad_episodes"),
        share("episodes", "all_episodes").alias("pct_all_episodes"),
        (F.col("w") + F.col("episodes") * 3 + F.col("findings")).alias("priority"),
    )


@R.add(
    SQL
    + f""", i AS (SELECT episode_path, count(*) AS n, bool_or(severity = 'critical' OR (severity = 'major' AND status = 'fail')) AS blocking
  FROM fd WHERE coalesce(status, '') <> 'pass' GROUP BY 1)
SELECT coalesce(operator, '{UNKNOWN}') AS operator, count(*) AS episodes, count(n) AS issue_episodes,
  count(*) FILTER (WHERE blocking) AS blocking_episodes, CAST(coalesce(sum(n), 0) AS BIGINT) AS findings,
  round(count(n) / count(*), 6) AS issue_share FROM ep LEFT JOIN i USING (episode_path) GROUP BY 1"""
)
def operator_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = flagged(clean_findings(spark, sf_dir)).groupBy("episode_path").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or((F.col("severity") == "critical") | ((F.col("severity") == "major") & (F.col("status") == "fail"))).alias("blocking"),
    )
    joined = clean_episodes(spark, sf_dir).join(issues, "episode_path", "left")
    return joined.groupBy(_known("operator").alias("operator")).agg(
        F.count(F.lit(1)).alias("episodes"),
        F.count("n").alias("issue_episodes"),
        F.count_if("blocking").alias("blocking_episodes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("findings"),
        F.round(F.count("n") / F.count(F.lit(1)), 6).alias("issue_share"),
    )


@R.add(
    SQL
    + """SELECT episode_path, check_name, count(*) AS findings, bool_or(coalesce(severity IN ('critical', 'major') AND status = 'fail', false)) AS blocks_training,
  array_to_string(list_sort(list(DISTINCT message))[1:5], ' | ') AS messages, min(phase) AS first_phase
FROM fd WHERE coalesce(status, '') <> 'pass' GROUP BY 1, 2"""
)
def affected_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each episode and check: findings, whether they block training, up to five messages."""
    blocks = F.coalesce(F.col("severity").isin("critical", "major") & (F.col("status") == "fail"), F.lit(False))
    return flagged(clean_findings(spark, sf_dir)).groupBy("episode_path", "check_name").agg(
        F.count(F.lit(1)).alias("findings"),
        F.bool_or(blocks).alias("blocks_training"),
        F.array_join(F.slice(F.sort_array(F.collect_set("message")), 1, 5), " | ").alias("messages"),
        F.min("phase").alias("first_phase"),
    )


@R.add(
    SQL
    + """, c AS (SELECT check_name, severity, task, robot, operator, episode_path FROM fd LEFT JOIN ep USING (episode_path) WHERE coalesce(status, '') <> 'pass')
SELECT check_name, severity, NULL AS task, NULL AS robot, NULL AS operator, count(*) AS findings, count(DISTINCT episode_path) AS episodes,
  1 AS level FROM c GROUP BY check_name, severity
UNION ALL SELECT NULL, NULL, task, robot, operator, count(*), count(DISTINCT episode_path), 2 FROM c GROUP BY task, robot, operator"""
)
def issue_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by check and severity, and by task, robot and operator."""
    states = flagged(clean_findings(spark, sf_dir)).groupBy("episode_path", "check_name", "severity").agg(F.count(F.lit(1)).alias("n"))
    names = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot", "operator")
    joined = states.join(names, "episode_path", "left")
    none = lambda c: F.lit(None).cast("string").alias(c)
    agg = (F.sum("n").alias("findings"), F.count_distinct("episode_path").alias("episodes"))
    a = states.groupBy("check_name", "severity").agg(*agg)
    b = joined.groupBy("task", "robot", "operator").agg(*agg)
    a = a.select("check_name", "severity", none("task"), none("robot"), none("operator"), "findings", "episodes", F.lit(1).alias("level"))
    return a.unionByName(b.select(none("check_name"), none("severity"), "task", "robot", "operator", "findings", "episodes", F.lit(2).alias("level")))


@R.add(
    SQL
    + """, c AS (SELECT episode_path, check_name, count(*) AS n, min(id) AS pos FROM fd WHERE coalesce(status, '') <> 'pass' AND check_name IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_path ORDER BY n DESC, pos) AS k FROM c)
SELECT episode_path, string_agg(check_name || '(' || n || ')', ', ' ORDER BY k) AS top_checks FROM r WHERE k <= 5 GROUP BY 1"""
)
def counter_text_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each episode's five commonest issues as text; ties by first appearance."""
    counts = (
        flagged(clean_findings(spark, sf_dir)).filter(F.col("check_name").isNotNull()).groupBy("episode_path", "check_name")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pos"))
    )
    # An episode has at most one row a check here.
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "pos", "check_name", "n"))), 1, 5)
    return counts.groupBy("episode_path").agg(top.alias("top")).select(
        "episode_path", F.array_join(F.transform("top", lambda x: F.concat(x.check_name, F.lit("("), x.n, F.lit(")"))), ", ").alias("top_checks")
    )


@R.add(
    SQL
    + f"""SELECT coalesce(robot, '{UNKNOWN}') AS robot, count(DISTINCT ep.episode_path) AS episodes,
  count(DISTINCT fd.episode_path) AS flagged_episodes, count(fd.id) AS findings,
  round(count(DISTINCT fd.episode_path) / count(DISTINCT ep.episode_path), 6) AS share
FROM ep LEFT JOIN fd ON ep.episode_path = fd.episode_path AND fd.check_name = 'duplicate_timestamps' GROUP BY 1"""
)
def robot_issue_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each robot's episodes with one check's finding."""
    hits = clean_findings(spark, sf_dir).filter(F.col("check_name") == "duplicate_timestamps").groupBy("episode_path").agg(F.count(F.lit(1)).alias("n"))
    joined = clean_episodes(spark, sf_dir).join(hits, "episode_path", "left")
    return joined.groupBy(_known("robot").alias("robot")).agg(
        F.count(F.lit(1)).alias("episodes"), F.count("n").alias("flagged_episodes"), F.coalesce(F.sum("n"), F.lit(0)).alias("findings"),
        F.round(F.count("n") / F.count(F.lit(1)), 6).alias("share"),
    )


@R.add(
    SQL
    + f"""SELECT CASE WHEN json_valid(details) THEN json_extract_string(details, '$.modality') END AS modality, count(*) AS findings,
  count(DISTINCT episode_path) AS episodes FROM fd GROUP BY 1"""
)
def json_field_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by a field of their details; broken details count as null."""
    valid = F.try_parse_json("details").isNotNull()
    modality = F.when(valid, F.get_json_object("details", "$.modality"))
    return clean_findings(spark, sf_dir).groupBy(modality.alias("modality")).agg(
        F.count(F.lit(1)).alias("findings"), F.count_distinct("episode_path").alias("episodes")
    )


@R.add(
    SQL
    + """, v AS (SELECT id, episode_path, check_name, CASE WHEN json_valid(details) THEN try_cast(json_extract_string(details, '$.value') AS DOUBLE) END AS value FROM fd)
SELECT id, episode_path, check_name, value FROM v WHERE isfinite(value) ORDER BY abs(value - 1.0), id LIMIT 50"""
)
def closest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 findings whose measured value is closest to one."""
    value = F.when(F.try_parse_json("details").isNotNull(), X.json_number(F.col("details"), "value"))
    out = clean_findings(spark, sf_dir).select("id", "episode_path", "check_name", value.alias("value")).filter("value IS NOT NULL")
    return out.orderBy(F.abs(F.col("value") - 1.0), "id").limit(50)


@R.add("SELECT count(*) AS n, max(id) AS max_id, (SELECT epoch_us(max(last_updated)) FROM episodes) AS updated_us FROM findings")
def change_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changes whenever the store does."""
    newest = table(spark, sf_dir, "episodes").agg(F.unix_micros(F.max("last_updated")).alias("updated_us"))
    return table(spark, sf_dir, "findings").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("max_id")).join(F.broadcast(newest), F.lit(True))


@R.add(
    SQL
    + f"""SELECT coalesce(robot, '{UNKNOWN}') AS robot, m AS metric, count(v) AS n, round(median(v), 6) AS median,
  round(quantile_cont(v, 0.01), 6) AS p1, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.75), 6) AS q3,
  round(quantile_cont(v, 0.99), 6) AS p99, round(1.2 * quantile_cont(v, 0.999), 6) AS suggested_limit, min(v) AS least, max(v) AS greatest
FROM (SELECT robot, 'p5_max_velocity' AS m, {metric("p5_max_velocity")} AS v FROM ep UNION ALL SELECT robot, 'p5_jitter_score', {metric("p5_jitter_score")} FROM ep)
WHERE v IS NOT NULL GROUP BY 1, 2"""
)
def calibration_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of robot metrics and a limit 20 % above the 99.9th percentile."""
    names = ("p5_max_velocity", "p5_jitter_score")
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), X.json_number(F.col("metrics"), m).alias("v")) for m in names])
    values = clean_episodes(spark, sf_dir).select(_known("robot").alias("robot"), F.inline(pairs)).filter("v IS NOT NULL")
    key = ["robot", "metric"]
    places = {"median": 0.5, "p1": 0.01, "q1": 0.25, "q3": 0.75, "p99": 0.99, "top": 0.999}
    ends = values.groupBy(*key).agg(F.min("v").alias("least"), F.max("v").alias("greatest"))
    out = grouped_quantiles(values, key, "v", places).join(ends, key).withColumn("suggested_limit", F.col("top") * 1.2)
    rounded = [F.round(c, 6).alias(c) for c in ("median", "p1", "q1", "q3", "p99", "suggested_limit")]
    return out.select(*key, "n", *rounded, "least", "greatest")


@R.add(
    SQL
    + f""", d AS (SELECT episode_path, task, robot, {_DURATION} AS d FROM ep WHERE {_DURATION} > 0 AND task IS NOT NULL AND robot IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY task, robot ORDER BY d, episode_path) AS k, count(*) OVER (PARTITION BY task, robot) AS n FROM d),
g AS (SELECT task, robot, any_value(n) AS n, median(d) AS med, median(d) FILTER (WHERE k > n - n // 2) - median(d) FILTER (WHERE k <= n // 2) AS iqr
  FROM o GROUP BY 1, 2)
SELECT episode_path, task, robot, d AS duration, round(med, 6) AS median, round(iqr, 6) AS iqr, round(abs(d - med) / iqr, 6) AS deviation,
  d / med AS ratio FROM d JOIN g USING (task, robot) WHERE n >= 5 AND iqr > 0 AND abs(d - med) / iqr > 3"""
)
def tukey_iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations more than three interquartile spreads off their task and robot's median."""
    d = X.positive(X.json_number(F.col("metrics"), "p2_duration_seconds"))
    rows = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot", d.alias("duration")).filter(
        "duration IS NOT NULL AND task IS NOT NULL AND robot IS NOT NULL"
    )
    half = lambda n: F.floor(n / 2)

    def middle(name: str, first, count) -> dict:
        return {f"{name}a": first + F.floor((count - 1) / 2), f"{name}z": first + F.floor(count / 2)}

    # Medians of all values, of their lower and of their upper half: six places, found without gathering a group.
    places = lambda n: middle("l", F.lit(0), half(n)) | middle("m", F.lit(0), n) | middle("u", n - half(n), half(n))
    mid = lambda c: (F.col(f"{c}a") + F.col(f"{c}z")) / 2
    groups = grouped_ranks(rows, ["task", "robot"], "duration", places).select("task", "robot", "n", mid("m").alias("median"), (mid("u") - mid("l")).alias("iqr"))
    groups = groups.filter("n >= 5 AND iqr > 0")
    off = F.abs(F.col("duration") - F.col("median")) / F.col("iqr")
    return rows.join(groups, ["task", "robot"]).filter(off > 3).select(
        "episode_path", "task", "robot", "duration", F.round("median", 6).alias("median"), F.round("iqr", 6).alias("iqr"),
        F.round(off, 6).alias("deviation"), (F.col("duration") / F.col("median")).alias("ratio"),
    )


@R.add(
    SQL
    + f""", d AS (SELECT episode_path, task, robot, {_DURATION} AS d FROM ep WHERE {_DURATION} > 0 AND task IS NOT NULL),
g AS (SELECT task, robot, count(*) AS n, median(d) AS med FROM d GROUP BY 1, 2)
SELECT episode_path, d.task, d.robot, round(d / med, 6) AS ratio, CASE WHEN d / med < 0.2 THEN 'too_short_fail' WHEN d / med < 0.4 THEN 'too_short_review' ELSE 'too_long_review' END AS tier
FROM d JOIN g ON d.task = g.task AND d.robot IS NOT DISTINCT FROM g.robot WHERE n >= 3 AND (d / med < 0.4 OR d / med > 2.5)"""
)
def duration_ratio_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations far below or above the median of their task and robot."""
    d = X.positive(X.json_number(F.col("metrics"), "p2_duration_seconds"))
    rows = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot", d.alias("d")).filter("d IS NOT NULL AND task IS NOT NULL")
    groups = grouped_quantiles(rows, ["task", "robot"], "d", {"med": 0.5})
    groups = groups.withColumnsRenamed({"task": "gt", "robot": "gr"})
    ratio = F.col("d") / F.col("med")
    tier = F.when(ratio < 0.2, "too_short_fail").when(ratio < 0.4, "too_short_review").otherwise("too_long_review")
    return rows.join(groups, (F.col("task") == F.col("gt")) & F.col("robot").eqNullSafe(F.col("gr"))).filter(
        (F.col("n") >= 3) & ((ratio < 0.4) | (ratio > 2.5))
    ).select("episode_path", "task", "robot", F.round(ratio, 6).alias("ratio"), tier.alias("tier"))


@R.add(
    SQL
    + f""", d AS (SELECT episode_path, task, coalesce(operator, '{UNKNOWN}') AS operator, {_DURATION} AS d FROM ep WHERE {_DURATION} > 0 AND task IS NOT NULL),
g AS (SELECT task, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.75) AS q3 FROM d GROUP BY 1),
u AS (SELECT d.*, d < greatest(0, q1 - 1.5 * (q3 - q1)) OR d > q3 + 1.5 * (q3 - q1) AS unusual FROM d JOIN g USING (task))
SELECT task, operator, count(*) AS episodes, count(*) FILTER (WHERE unusual) AS unusual, round(100.0 * count(*) FILTER (WHERE unusual) / count(*), 4) AS pct
FROM u GROUP BY 1, 2"""
)
def fence_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each operator's durations leave their task's fences."""
    d = X.positive(X.json_number(F.col("metrics"), "p2_duration_seconds"))
    rows = clean_episodes(spark, sf_dir).select("task", _known("operator").alias("operator"), d.alias("d")).filter("d IS NOT NULL AND task IS NOT NULL")
    fences = grouped_quantiles(rows, ["task"], "d", {"q1": 0.25, "q3": 0.75}).drop("n")
    spread = (F.col("q3") - F.col("q1")) * 1.5
    unusual = (F.col("d") < F.greatest(F.lit(0.0), F.col("q1") - spread)) | (F.col("d") > F.col("q3") + spread)
    return rows.join(fences, "task").groupBy("task", "operator").agg(
        F.count(F.lit(1)).alias("episodes"), F.count_if(unusual).alias("unusual"), F.round(F.count_if(unusual) * 100.0 / F.count(F.lit(1)), 4).alias("pct")
    )


@R.add(
    SQL
    + f""", x AS (SELECT robot, {metric("p5_max_velocity")} AS a, {metric("p5_jitter_score")} AS b FROM ep WHERE robot IS NOT NULL),
y AS (SELECT * FROM x WHERE abs(a) < 1e6 AND abs(b) < 1e6),
r AS (SELECT robot, a, b, rank() OVER (PARTITION BY robot ORDER BY a) + (count(*) OVER (PARTITION BY robot, a) - 1) / 2.0 AS ra,
  rank() OVER (PARTITION BY robot ORDER BY b) + (count(*) OVER (PARTITION BY robot, b) - 1) / 2.0 AS rb FROM y)
SELECT robot, count(*) AS n, round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman, round(regr_r2(b, a), 6) AS r2
FROM r GROUP BY 1 HAVING count(*) > 2 AND stddev(a) > 0 AND stddev(b) > 0"""
)
def corr_spearman_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How velocity and jitter go together on each robot; values out of all proportion are left out."""
    a, b = X.json_number(F.col("metrics"), "p5_max_velocity"), X.json_number(F.col("metrics"), "p5_jitter_score")
    rows = clean_episodes(spark, sf_dir).select("robot", a.alias("a"), b.alias("b")).filter("robot IS NOT NULL AND abs(a) < 1e6 AND abs(b) < 1e6")

    ranked = average_ranks(average_ranks(rows, ["robot"], "a", "ra"), ["robot"], "b", "rb")
    out = ranked.groupBy("robot").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.corr("a", "b"), 6).alias("pearson"), F.round(F.corr("ra", "rb"), 6).alias("spearman"),
        F.round(F.regr_r2("b", "a"), 6).alias("r2"), F.stddev("a").alias("sa"), F.stddev("b").alias("sb"),
    )
    return out.filter("n > 2 AND sa > 0 AND sb > 0").drop("sa", "sb")


@R.add(
    SQL
    + f"""SELECT episode_path, {_PENDING} AS final_status, epoch_us(last_updated) AS updated_us FROM ep ORDER BY CASE {_PENDING} WHEN 'fail' THEN 0 WHEN 'needs_review' THEN 1
  WHEN 'warning' THEN 2 WHEN 'pending' THEN 3 WHEN 'pass' THEN 4 ELSE 5 END, last_updated DESC NULLS LAST, episode_path LIMIT 100"""
)
def dashboard_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred rows a dashboard shows first: worst status, then newest."""
    status = F.coalesce("final_status", F.lit("pending"))
    out = clean_episodes(spark, sf_dir).select("episode_path", status.alias("final_status"), "last_updated")
    rank = F.lit(5)
    for i, s in enumerate(("fail", "needs_review", "warning", "pending", "pass")):
        rank = F.when(F.col("final_status") == s, i).otherwise(rank)
    return out.orderBy(rank, F.desc_nulls_last("last_updated"), "episode_path").limit(100).select(
        "episode_path", "final_status", F.unix_micros("last_updated").alias("updated_us")
    )


@R.add(SQL + "SELECT * FROM (SELECT id, episode_path, check_name, severity, status FROM fd ORDER BY id DESC LIMIT 200) ORDER BY id")
def recent_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 200 findings in ascending order."""
    rows = clean_findings(spark, sf_dir).select("id", "episode_path", "check_name", "severity", "status")
    return rows.orderBy(F.desc("id")).limit(200).orderBy("id")


@R.add(
    SQL
    + """SELECT task, episode_path, epoch_us(last_updated) AS updated_us FROM (SELECT task, episode_path, last_updated, row_number() OVER (PARTITION BY task ORDER BY last_updated DESC NULLS LAST, episode_path) AS k
  FROM ep WHERE final_status IN ('fail', 'needs_review') AND task IS NOT NULL) WHERE k <= 5"""
)
def worst_recent_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five newest flagged episodes of each task."""
    rows = clean_episodes(spark, sf_dir).filter(F.col("final_status").isin("fail", "needs_review") & F.col("task").isNotNull())
    by = Window.partitionBy("task").orderBy(F.desc_nulls_last("last_updated"), "episode_path")
    # A rank limit lets each partition keep five rows a task before the shuffle.
    return rows.withColumn("k", F.row_number().over(by)).filter("k <= 5").select("task", "episode_path", F.unix_micros("last_updated").alias("updated_us"))


@R.add(
    SQL
    + """SELECT check_name, modality, id AS first_id FROM (SELECT check_name, CASE WHEN json_valid(details) THEN json_extract_string(details, '$.modality') END AS modality, id FROM fd)
QUALIFY row_number() OVER (PARTITION BY check_name, modality ORDER BY id) = 1"""
)
def first_seen_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different checks and modalities with where they were first seen."""
    modality = F.when(F.try_parse_json("details").isNotNull(), F.get_json_object("details", "$.modality"))
    return clean_findings(spark, sf_dir).groupBy("check_name", modality.alias("modality")).agg(F.min("id").alias("first_id"))


@R.add(
    SQL
    + f"""SELECT coalesce(task, '{UNKNOWN}') AS task, coalesce(robot, '{UNKNOWN}') AS robot, coalesce(operator, '{UNKNOWN}') AS operator,
  epoch_us(max(last_updated)) AS newest_us, count(*) AS warnings, count(*) > 20 AS hidden FROM ep WHERE final_status = 'warning' GROUP BY 1, 2, 3"""
)
def newest_warning_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_episodes(spark, sf_dir).filter(F.col("final_status") == "warning")
    keys = [_known(c).alias(c) for c in ("task", "robot", "operator")]
    return rows.groupBy(*keys).agg(F.unix_micros(F.max("last_updated")).alias("newest_us"), F.count(F.lit(1)).alias("warnings"), (F.count(F.lit(1)) > 20).alias("hidden"))


@R.add(
    SQL
    + """SELECT DISTINCT episode_path FROM (SELECT episode_path FROM ep UNION SELECT episode_path FROM frame_times WHERE episode_path IS NOT NULL)"""
)
def set_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "episodes").select("episode_path")
    return a.union(table(spark, sf_dir, "frame_times").select("episode_path").filter("episode_path IS NOT NULL")).distinct()


@R.add("SELECT episode_path FROM actions_eef_pose INTERSECT SELECT episode_path FROM frame_times")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "actions_eef_pose").select("episode_path")
    return a.intersect(table(spark, sf_dir, "frame_times").select("episode_path"))


@R.add("SELECT episode_path FROM findings EXCEPT SELECT episode_path FROM episodes")
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths with findings that are no episode."""
    a = table(spark, sf_dir, "findings").select("episode_path")
    return a.subtract(table(spark, sf_dir, "episodes").select("episode_path"))


@R.add(
    """SELECT 'episodes' AS source_db, episode_path, count(*) AS n FROM episodes GROUP BY ALL UNION ALL
SELECT 'trim_plan', episode_path, count(*) FROM trim_plan GROUP BY ALL"""
)
def union_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several stores under one another, with where they come from."""
    tagged = [table(spark, sf_dir, t).select(F.lit(t).alias("source_db"), "episode_path") for t in ("episodes", "trim_plan")]
    return tagged[0].unionByName(tagged[1]).groupBy("source_db", "episode_path").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
