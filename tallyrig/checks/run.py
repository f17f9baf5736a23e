"""The run of all phases: their order, one table of findings, and each episode's way through them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrig.checks import robot_state, timestamps
from tallyrig.functions import exprs as X
from tallyrig.plans import reports, selection, series
from tallyrig.plans.base import clean_episodes
from tallyrig.plans.registry import Registry

R = Registry()


@dataclass(frozen=True)
class Phase:
    """One phase: its findings, and the phases that must have run before."""

    number: int
    name: str
    findings: Callable[[SparkSession, str], DataFrame]
    sql: str
    needs: tuple[int, ...] = ()


def _plain(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        subject = F.col("subject") if "subject" in rows.columns else F.lit(None).cast("string").alias("subject")
        return rows.select("episode_path", "check_name", "severity", "status", subject)

    return findings


_PLAIN = "SELECT episode_path, check_name, severity, status, {0} AS subject FROM ({1})"


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of phase 2: of each episode's own numbers, of its streams' row counts, and against its task and robot."""
    key = ["episode_path"]
    own = selection.check_phase2(spark, sf_dir).withColumn("subject", F.lit(None).cast("string"))
    f = robot_state.finding
    counts = robot_state.emitted(selection.frame_count_alignment(spark, sf_dir), key, [
        f("modality_frame_count_misaligned", F.when(F.col("alignment") == "warning", "minor").otherwise("major"), F.col("alignment"), F.col("alignment") != "pass"),
        f("timestamps_row_count_mismatch", "major", "fail", F.col("count_mismatch"), F.col("most")),
    ])
    ratio = F.col("tier")
    lengths = robot_state.emitted(reports.duration_ratio_outliers(spark, sf_dir), key, [
        f("duration_absolute_too_short", F.when(ratio == "too_short_fail", "major").otherwise("minor"), F.when(ratio == "too_short_fail", "fail").otherwise("needs_review"), ratio.startswith("too_short")),
        f("duration_absolute_too_long", "minor", "needs_review", ratio == "too_long_review"),
    ])
    outliers = robot_state.emitted(reports.tukey_iqr_outliers(spark, sf_dir), key, [f("duration_task_outlier", "minor", "needs_review", F.lit(True))])
    columns = ["episode_path", "check_name", "severity", "status", "subject"]
    return own.select(columns).unionByName(counts.select(columns)).unionByName(lengths.select(columns)).unionByName(outliers.select(columns))


_DURATIONS = f"""{_PLAIN.format("NULL::VARCHAR", selection.R.sql["check_phase2"])}
UNION ALL SELECT episode_path, 'modality_frame_count_misaligned', CASE alignment WHEN 'warning' THEN 'minor' ELSE 'major' END, alignment, NULL FROM ({selection.R.sql["frame_count_alignment"]}) WHERE alignment <> 'pass'
UNION ALL SELECT episode_path, 'timestamps_row_count_mismatch', 'major', 'fail', most FROM ({selection.R.sql["frame_count_alignment"]}) WHERE count_mismatch
UNION ALL SELECT episode_path, CASE WHEN tier = 'too_long_review' THEN 'duration_absolute_too_long' ELSE 'duration_absolute_too_short' END, CASE WHEN tier = 'too_short_fail' THEN 'major' ELSE 'minor' END,
  CASE WHEN tier = 'too_short_fail' THEN 'fail' ELSE 'needs_review' END, NULL FROM ({reports.R.sql["duration_ratio_outliers"]})
UNION ALL SELECT episode_path, 'duration_task_outlier', 'minor', 'needs_review', NULL FROM ({reports.R.sql["tukey_iqr_outliers"]})"""


def standstill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of phase 7: each long standstill by where it is, and the share of it in the episode."""
    segments = series.stillness_segments(spark, sf_dir)
    status = F.col("status")
    severity = F.when(status == "warning", "minor").otherwise("major")
    made = [
        robot_state.finding(f"operator_standstill_{place}", severity, status, (status != "pass") & (F.col("location") == place)) for place in ("leading", "middle", "trailing")
    ]
    found = robot_state.emitted(segments, ["episode_path"], made).drop("measured")
    ratios = selection.check_phase7(spark, sf_dir).filter("check_name <> 'frame_drop_ratio'").withColumn("subject", F.lit(None).cast("string"))
    return found.unionByName(ratios)


_STANDSTILL = f"""SELECT episode_path, 'operator_standstill_' || location AS check_name, CASE status WHEN 'warning' THEN 'minor' ELSE 'major' END AS severity, status, NULL::VARCHAR AS subject
  FROM ({series.R.sql["stillness_segments"]}) WHERE status <> 'pass'
UNION ALL {_PLAIN.format("NULL", selection.R.sql["check_phase7"])} WHERE check_name <> 'frame_drop_ratio'"""

#: The phases that judge tables.  Phase 4 (videos) and 6 (handheld processing) add findings from their own stages.
PHASES = (
    Phase(1, "metadata", _plain(selection.check_phase1), _PLAIN.format("NULL::VARCHAR", selection.R.sql["check_phase1"])),
    Phase(2, "duration", durations, _DURATIONS, (1,)),
    Phase(3, "timestamps", _plain(timestamps.check_phase3), _PLAIN.format("subject", timestamps.R.sql["check_phase3"]), (1,)),
    Phase(5, "robot state", _plain(robot_state.check_phase5), _PLAIN.format("subject", robot_state.R.sql["check_phase5"]), (1,)),
    Phase(7, "standstill", standstill, _STANDSTILL, (1,)),
)


def ordered_phases(wanted: list[int] | None = None) -> list[Phase]:
    """The phases asked for in the order of a run.

    An unknown number, or a phase whose needs are not among those asked for, is
    an error.
    """
    by_number = {p.number: p for p in PHASES}
    chosen = sorted(by_number if wanted is None else set(wanted))
    for number in chosen:
        if number not in by_number:
            raise ValueError(f"there is no phase {number}")
        missing = [n for n in by_number[number].needs if n not in chosen]
        if missing:
            raise ValueError(f"phase {number} needs {missing}")
    return [by_number[n] for n in chosen]


_ALL = " UNION ALL ".join(f"SELECT {p.number} AS phase, * FROM ({p.sql})" for p in PHASES)


@R.add(_ALL)
def all_findings(spark: SparkSession, sf_dir: str, phases: list[int] | None = None) -> DataFrame:
    """The findings of all phases in one table: ``phase, episode_path, check_name, severity, status, subject``."""
    made = [p.findings(spark, sf_dir).select(F.lit(p.number).alias("phase"), "episode_path", "check_name", "severity", "status", "subject") for p in ordered_phases(phases)]
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


_DECIDE = """CASE WHEN count(f.check_name) = 0 THEN 'pass' WHEN bool_or(severity = 'critical') THEN 'fail' WHEN bool_or(severity = 'major' AND status = 'fail') THEN 'fail'
  WHEN bool_or(status = 'needs_review') THEN 'needs_review' WHEN bool_or(severity IN ('major', 'minor')) THEN 'warning' ELSE 'pass' END"""


@R.add(
    f"""WITH f AS ({_ALL}), e AS (SELECT DISTINCT episode_path FROM episodes), p(phase) AS (VALUES {", ".join(f"({p.number})" for p in PHASES)}),
s AS (SELECT e.episode_path, p.phase, {_DECIDE} AS decided FROM e CROSS JOIN p LEFT JOIN f ON f.episode_path = e.episode_path AND f.phase = p.phase GROUP BY 1, 2),
c AS (SELECT *, coalesce(bool_or(decided = 'fail') OVER (PARTITION BY episode_path ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM s)
SELECT episode_path, count(*) FILTER (WHERE NOT stopped) AS phases_run, min(phase) FILTER (WHERE decided = 'fail') AS stopped_at,
  string_agg(phase || ':' || CASE WHEN stopped THEN 'skipped' ELSE decided END, ' ' ORDER BY phase) AS phases,
  CASE WHEN bool_or(decided = 'fail') THEN 'fail' WHEN bool_or(decided = 'needs_review') THEN 'needs_review' WHEN bool_or(decided = 'warning') THEN 'warning' ELSE 'pass' END AS verdict FROM c GROUP BY 1"""
)
def pipeline_run(spark: SparkSession, sf_dir: str, phases: list[int] | None = None) -> DataFrame:
    """Each episode's way through the phases: after one that fails the others are skipped.

    Findings are decided to a status an episode and phase by an aggregate that
    combines early; an episode then has one row a phase.
    """
    chosen = ordered_phases(phases)
    decided = all_findings(spark, sf_dir, phases).groupBy("episode_path", "phase").agg(X.decide_status(F.col("severity"), F.col("status")).alias("decided"))
    numbers = F.array(*[F.lit(p.number) for p in chosen])
    every = clean_episodes(spark, sf_dir).select("episode_path", F.explode(numbers).alias("phase"))
    before = Window.partitionBy("episode_path").orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)
    status = every.join(decided, ["episode_path", "phase"], "left").withColumn("decided", F.coalesce("decided", F.lit("pass")))
    stopped = F.coalesce(F.bool_or(F.col("decided") == "fail").over(before), F.lit(False))
    status = status.withColumn("stopped", stopped)
    shown = F.concat(F.col("phase").cast("string"), F.lit(":"), F.when(F.col("stopped"), "skipped").otherwise(F.col("decided")))
    has = lambda s: F.bool_or(F.col("decided") == s)
    return status.groupBy("episode_path").agg(
        F.count_if(~F.col("stopped")).alias("phases_run"),
        F.min(F.when(F.col("decided") == "fail", F.col("phase"))).alias("stopped_at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("phase", shown.alias("t")))), lambda x: x.t), " ").alias("phases"),
        F.when(has("fail"), "fail").when(has("needs_review"), "needs_review").when(has("warning"), "warning").otherwise("pass").alias("verdict"),
    )


def queries() -> dict:
    return R.queries


def oracle_sql() -> dict:
    return R.sql
