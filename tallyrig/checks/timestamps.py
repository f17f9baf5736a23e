"""Phase 3: findings about the timing of image streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.checks.robot_state import emitted, finding, share_tiers
from tallyrig.config import DEFAULTS
from tallyrig.functions import exprs as X
from tallyrig.functions.text import is_fresh
from tallyrig.operators.ordered import CHUNK_ROWS, with_previous
from tallyrig.operators.quantile import grouped_median, grouped_ranks
from tallyrig.plans import series
from tallyrig.plans.base import SQL, clean_episodes
from tallyrig.plans.registry import Registry
from tallyrig.plans.series import FRAME
from tallyrig.session import table, written

R = Registry()
_P = DEFAULTS["phase3"]
_TIERS = "CASE WHEN {0} >= 0.01 THEN 'major' ELSE 'minor' END, CASE WHEN {0} >= 0.05 THEN 'fail' WHEN {0} >= 0.01 THEN 'needs_review' ELSE 'warning' END"


def _sub(name: str) -> str:
    """The SQL of another query, as a table."""
    return f"({series.R.sql[name]})"


@R.add(
    SQL
    + f""", d AS (SELECT task, robot, modality, episode_path, longest FROM {_sub("drop_runs")} JOIN ep USING (episode_path) WHERE task IS NOT NULL AND robot IS NOT NULL),
o AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY task, robot, modality) AS n FROM d WINDOW w AS (PARTITION BY task, robot, modality ORDER BY longest, episode_path)),
g AS (SELECT task, robot, modality, any_value(n) AS n, median(longest) AS med, median(longest) FILTER (WHERE k > n - n // 2) - median(longest) FILTER (WHERE k <= n // 2) AS iqr FROM o GROUP BY 1, 2, 3)
SELECT episode_path, modality, longest, n AS group_size, CASE WHEN n >= 5 THEN 'major' ELSE 'minor' END AS severity, CASE WHEN n >= 5 THEN 'needs_review' ELSE 'warning' END AS status
FROM d JOIN g USING (task, robot, modality) WHERE (n >= 5 AND iqr > 0 AND longest > med + 3 * iqr) OR (n < 5 AND longest >= 10)"""
)
def consecutive_drops_outlier(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS, runs: DataFrame | None = None) -> DataFrame:
    """Streams whose longest run of stale frames is far beyond those of their task and robot; a fixed bound in small groups.

    ``runs`` may give the result of ``drop_runs`` where it is there already.
    """
    names = clean_episodes(spark, sf_dir).select("episode_path", "task", "robot").filter("task IS NOT NULL AND robot IS NOT NULL")
    runs = series.drop_runs(spark, sf_dir, chunk_rows) if runs is None else runs
    rows = runs.select(*FRAME, "longest").join(names, "episode_path")
    key = ["task", "robot", "modality"]
    half = lambda n: F.floor(n / 2)
    middle = lambda name, first, n: {f"{name}a": first + F.floor((n - 1) / 2), f"{name}z": first + F.floor(n / 2)}
    places = lambda n: middle("l", F.lit(0), half(n)) | middle("m", F.lit(0), n) | middle("u", n - half(n), half(n))
    mid = lambda c: (F.col(f"{c}a") + F.col(f"{c}z")) / 2
    groups = grouped_ranks(rows, key, "longest", places).select(*key, "n", mid("m").alias("median"), (mid("u") - mid("l")).alias("iqr"))
    many = F.col("n") >= _P["group"]
    far = many & (F.col("iqr") > 0) & (F.col("longest") > F.col("median") + _P["iqr"] * F.col("iqr"))
    return rows.join(groups, key).filter(far | (~many & (F.col("longest") >= _P["drop_run_warn"]))).select(
        *FRAME, "longest", F.col("n").alias("group_size"),
        F.when(many, "major").otherwise("minor").alias("severity"), F.when(many, "needs_review").otherwise("warning").alias("status"),
    )


@R.add(
    rf"""WITH u AS (SELECT DISTINCT episode_path, modality, timestamp_ms AS t FROM frame_times WHERE timestamp_ms IS NOT NULL AND isfinite(timestamp_ms) AND lower(regexp_replace(is_new, '^\s+|\s+$', '', 'g')) IN ('1', 'true', 'yes')),
g AS (SELECT *, t - lag(t) OVER (PARTITION BY episode_path, modality ORDER BY t) AS gap FROM u)
SELECT episode_path, modality, round(max(gap), 6) AS largest_gap, round(median(gap), 6) AS median_gap, CASE WHEN max(gap) > 20 * median(gap) THEN 'fail' ELSE 'warning' END AS status
FROM g GROUP BY 1, 2 HAVING median(gap) > 0 AND max(gap) > 5 * median(gap)"""
)
def timestamp_large_gap(spark: SparkSession, sf_dir: str, chunk_ms: int = 300_000) -> DataFrame:
    """Streams with a gap between fresh times that is many times their usual one; no part of phase 3 by default."""
    rows = table(spark, sf_dir, "frame_times").filter(
        is_fresh(F.col("is_new"), F.col("timestamp_ms")) & X.finite(F.col("timestamp_ms")) & F.col("episode_path").isNotNull() & F.col("modality").isNotNull()
    )
    times = rows.select(*FRAME, F.col("timestamp_ms").alias("t")).distinct()
    gaps = with_previous(times, FRAME, "t", ["t"], chunk_ms).select(*FRAME, (F.col("t") - F.col("prev_t")).alias("gap"))
    out = grouped_median(gaps, FRAME, "gap", "usual").join(gaps.groupBy(*FRAME).agg(F.max("gap").alias("gap")), FRAME)
    usual, gap = F.col("usual"), F.col("gap")
    return out.filter((usual > 0) & (gap > _P["gap_warn"] * usual)).select(
        *FRAME, F.round(gap, 6).alias("largest_gap"), F.round(usual, 6).alias("median_gap"), F.when(gap > _P["gap_fail"] * usual, "fail").otherwise("warning").alias("status")
    )


@R.add(
    f"""WITH m AS {_sub("monotonic_violations")}, d AS {_sub("drop_runs")}, f AS {_sub("fps_deviation")}, a AS {_sub("alignment_spread")}
SELECT episode_path, 'timestamps_unreadable' AS check_name, 'major' AS severity, 'fail' AS status, modality AS subject, NULL::DOUBLE AS measured
  FROM frame_times GROUP BY episode_path, modality HAVING count(*) FILTER (WHERE isfinite(timestamp_ms)) = 0
UNION ALL SELECT episode_path, 'timestamps_not_monotonic', {_TIERS.format("violations / n")}, modality, round(violations / n, 5) FROM m WHERE violations > 0
UNION ALL SELECT episode_path, 'duplicate_timestamps', {_TIERS.format("duplicates / n")}, modality, round(duplicates / n, 5) FROM m WHERE duplicates > 0
UNION ALL SELECT episode_path, 'frame_drop_ratio', 'major', 'fail', modality, round(stale / n, 5) FROM d WHERE stale / n > CASE WHEN contains(modality, 'tactile') THEN 0.15 ELSE 0.1 END
UNION ALL SELECT episode_path, 'frame_drop_consecutive', 'major', 'fail', modality, longest FROM d WHERE longest >= 25
UNION ALL SELECT episode_path, verdict, CASE WHEN verdict = 'abnormal_fps_loss' THEN 'major' ELSE 'minor' END, CASE WHEN verdict = 'abnormal_fps_loss' THEN 'fail' ELSE 'warning' END, modality, round(actual_fps / expected_fps, 5) FROM f WHERE verdict <> 'ok'
UNION ALL SELECT episode_path, 'modality_alignment_start', 'major', 'fail', NULL, round(start_spread, 5) FROM a WHERE start_misaligned
UNION ALL SELECT episode_path, 'modality_alignment_end', 'major', 'fail', NULL, round(end_spread, 5) FROM a WHERE end_misaligned
UNION ALL SELECT episode_path, 'consecutive_drops_outlier', severity, status, modality, longest FROM ({R.sql["consecutive_drops_outlier"]})"""
)
def check_phase3(spark: SparkSession, sf_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Findings of the timing checks: ``episode_path, check_name, severity, status, subject, measured``; ``subject`` is the modality."""
    key, modality = ["episode_path"], F.col("modality")
    times = table(spark, sf_dir, "frame_times").groupBy(*FRAME).agg(F.count_if(X.finite(F.col("timestamp_ms"))).alias("times"))
    unread = emitted(times, key, [finding("timestamps_unreadable", "major", "fail", F.col("times") == 0, modality)])

    back, same = F.col("violations") / F.col("n"), F.col("duplicates") / F.col("n")
    order = emitted(series.monotonic_violations(spark, sf_dir, chunk_rows), key, [
        finding("timestamps_not_monotonic", *share_tiers(back), back > 0, modality, back),
        finding("duplicate_timestamps", *share_tiers(same), same > 0, modality, same),
    ])

    # Written once, a row a stream; it is looked at twice.
    runs = written(series.drop_runs(spark, sf_dir, chunk_rows))
    stale, longest = F.col("stale") / F.col("n"), F.col("longest")
    most = F.when(modality.contains("tactile"), _P["tactile_drop_ratio"]).otherwise(_P["drop_ratio"])
    drops = emitted(runs, key, [
        finding("frame_drop_ratio", "major", "fail", stale > most, modality, stale),
        finding("frame_drop_consecutive", "major", "fail", longest >= _P["drop_run_fail"], modality, longest),
    ])

    rate = F.col("actual_fps") / F.col("expected_fps")
    fps = emitted(series.fps_deviation(spark, sf_dir), key, [
        finding("abnormal_fps_loss", "major", "fail", F.col("verdict") == "abnormal_fps_loss", modality, rate),
        finding("abnormal_fps_gain", "minor", "warning", F.col("verdict") == "abnormal_fps_gain", modality, rate),
    ])

    aligned = emitted(series.alignment_spread(spark, sf_dir), key, [
        finding(f"modality_alignment_{end}", "major", "fail", F.col(f"{end}_misaligned"), None, F.col(f"{end}_spread")) for end in ("start", "end")
    ])
    outliers = consecutive_drops_outlier(spark, sf_dir, chunk_rows, runs)
    far = emitted(outliers, key, [finding("consecutive_drops_outlier", F.col("severity"), F.col("status"), F.lit(True), modality, longest)])
    return unread.unionByName(order).unionByName(drops).unionByName(fps).unionByName(aligned).unionByName(far)


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
