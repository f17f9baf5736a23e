"""Clean views of the episode tables that all reports start from, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.functions.text import tidy_name
from tallyrig.session import table


def clean_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of each episode, names tidied, blanks as null.

    Versions and copies are reduced by an aggregate that combines on the map
    side, so a much repeated episode costs one row a partition.
    """
    raw = table(spark, sf_dir, "episodes")
    plain = ["task", "robot", "operator", "date", "final_status", "training_ready", "metrics", "controller"]
    versions = raw.select(
        "episode_path",
        F.struct(
            "last_updated",
            *plain,
            "phases_completed",
            F.array_sort(F.map_entries("phase_status")).alias("phases"),
        ).alias("e"),
    )
    latest = versions.groupBy("episode_path").agg(F.max("e").alias("e")).select("episode_path", "e.*")
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return latest.select(
        "episode_path",
        tidy_name(F.col("task")).alias("task"),
        tidy_name(F.col("robot")).alias("robot"),
        tidy_name(F.col("operator")).alias("operator"),
        F.nullif(F.replace(F.trim("date"), F.lit("-"), F.lit("")), F.lit("")).alias("date"),
        blank("final_status").alias("final_status"),
        tidy_name(F.col("controller")).alias("controller"),
        "phases_completed",
        F.map_from_entries("phases").alias("phase_status"),
        "metrics",
        "training_ready",
        "last_updated",
    )


def clean_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings, each id once."""
    raw = table(spark, sf_dir, "findings")
    columns = ["episode_path", "phase", "check_name", "severity", "status", "message", "details"]
    return raw.groupBy("id").agg(F.max(F.struct(*columns)).alias("f")).select("id", "f.*")


_TIDY = r"nullif(regexp_replace(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '^_+|_+$', '', 'g'), '')"

#: Common table expressions ``ep`` and ``fd``, as the two functions give them.
SQL = (
    """WITH ep0 AS (SELECT * FROM episodes QUALIFY row_number() OVER (PARTITION BY episode_path ORDER BY
  last_updated DESC NULLS LAST, task DESC NULLS LAST, robot DESC NULLS LAST, operator DESC NULLS LAST, date DESC NULLS LAST,
  final_status DESC NULLS LAST, training_ready DESC NULLS LAST, metrics DESC NULLS LAST, controller DESC NULLS LAST) = 1),
ep AS (SELECT episode_path, """
    + ", ".join(f"{_TIDY.format(c)} AS {c}" for c in ("task", "robot", "operator"))
    + """, nullif(replace(trim(date), '-', ''), '') AS date, nullif(trim(final_status), '') AS final_status, """
    + _TIDY.format("controller")
    + """ AS controller, phases_completed, phase_status, metrics, training_ready, last_updated FROM ep0),
fd AS (SELECT DISTINCT * FROM findings)
"""
)


def metric(name: str) -> str:
    """SQL of a finite number in ``ep.metrics``."""
    return (
        f"(CASE WHEN json_valid(metrics) AND isfinite(try_cast(json_extract_string(metrics, '$.{name}') AS DOUBLE))"
        f" THEN try_cast(json_extract_string(metrics, '$.{name}') AS DOUBLE) END)"
    )
