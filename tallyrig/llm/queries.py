"""The queries p2_, p5_ to p10_ over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.functions.text import is_fresh, tidy_name
from tallyrig.llm.canonical import canonical_documents, look_alike_classes, look_alike_pairs
from tallyrig.llm.leaks import leaked_passages
from tallyrig.llm.mixing import TOKENIZER_DIR, mix_shares, mix_sources, token_count
from tallyrig.llm.multiselect import combined_percentiles, percentiles, summarise
from tallyrig.llm.nearest import nearest_by_time
from tallyrig.llm.runs import collapse_runs
from tallyrig.llm.splits import grouped_split
from tallyrig.plans.dealt import latest_episodes
from tallyrig.session import table, written

#: Problem 5: the percentiles.
QUANTILES = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]
#: Problem 6: the stated proportions.
SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
JOINTS = [f"j{i}" for i in range(1, 8)]


def p2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fresh frame with its nearest pose and the time between them."""
    frames = table(spark, sf_dir, "frame_times")
    fresh = frames.filter(is_fresh(F.col("is_new"), F.col("timestamp_ms"))).withColumnRenamed(
        "row_idx", "frame_row_idx"
    )
    poses = table(spark, sf_dir, "actions_eef_pose")
    return nearest_by_time(
        fresh, poses, "episode_path", ["modality", "frame_row_idx"], "row_idx", tolerance=20.0
    ).withColumnRenamed("right_id", "pose_row_idx")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_pairs(spark, sf_dir).select("episode_path", "modality", "frame_row_idx", "pose_row_idx")


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``robot, date, metric, value``: every key of each current episode's metrics that reads as a number."""
    each = F.explode(F.map_entries(F.from_json("metrics", "map<string,string>")))
    rows = latest_episodes(spark, sf_dir).select(F.coalesce("robot", F.lit("(unknown)")).alias("robot"), "date", each.alias("e"))
    value = F.col("e.value").try_cast("double")
    return rows.select("robot", "date", F.col("e.key").alias("metric"), value.alias("value")).filter(value.isNotNull())


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of each metric per robot; the error is zero."""
    out = percentiles(p5_values(spark, sf_dir), ["robot", "metric"], "value", QUANTILES)
    return out.withColumn("value", F.round("value", 6))


def p5_combined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one summary a day, within half a percent of the exact values."""
    days = summarise(p5_values(spark, sf_dir), ["robot", "metric", "date"], "value")
    out = combined_percentiles(days, ["robot", "metric"], QUANTILES)
    return out.withColumn("value", F.round("value", 6))


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of each episode.

    The operator is taken without case, blanks and separators; where it is
    missing, from the episode's path, so one operator stays in one split.
    """
    operator = F.coalesce(
        tidy_name(F.col("operator")),
        tidy_name(F.nullif(F.regexp_extract("episode_path", r"/([^/]+)/episode_[^/]*$", 1), F.lit(""))),
    )
    episodes = table(spark, sf_dir, "episodes").select(
        "episode_path", operator.alias("operator"), tidy_name(F.col("task")).alias("task"), "training_ready"
    )
    return grouped_split(episodes, "episode_path", "operator", ["task", "training_ready"], SHARES)


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes and shares of each split: in all, per training_ready and per task."""
    splits = p6_splits(spark, sf_dir).select("episode_path", "split")
    names = latest_episodes(spark, sf_dir).select("episode_path", "task", F.col("training_ready").cast("string").alias("training_ready"))
    kinds = F.array(
        F.struct(F.lit("all").alias("label"), F.lit("all").alias("value")),
        *[F.struct(F.lit(c).alias("label"), F.coalesce(c, F.lit("(null)")).alias("value")) for c in ("training_ready", "task")],
    )
    joined = written(splits.join(names, "episode_path").groupBy("task", "training_ready", "split").agg(F.count(F.lit(1)).alias("n")))
    counts = joined.select("split", "n", F.inline(kinds)).groupBy("label", "value", "split").agg(F.sum("n").alias("episodes"))
    total = counts.groupBy("label", "value").agg(F.sum("episodes").alias("n"))
    return counts.join(total, ["label", "value"]).select("label", "value", "split", "episodes", F.round(F.col("episodes") / F.col("n"), 6).alias("share"))


def p6_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the splits, and whether it does: ``rule, holds, counted``."""
    splits = written(p6_splits(spark, sf_dir))
    episodes = table(spark, sf_dir, "episodes").select("episode_path", tidy_name(F.col("operator")).alias("operator")).distinct()
    spread = splits.join(episodes, "episode_path").filter("operator IS NOT NULL").groupBy("operator").agg(F.count_distinct("split").alias("k"))
    operators = spread.agg(F.coalesce(F.max("k") <= 1, F.lit(True)).alias("holds"), F.count(F.lit(1)).alias("counted"))
    each = splits.groupBy("episode_path").agg(F.count(F.lit(1)).alias("k"))
    once = each.agg(F.coalesce(F.max("k") <= 1, F.lit(True)).alias("holds"), F.count(F.lit(1)).alias("counted"))
    by = splits.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    off = F.lit(False)
    for s, share in SHARES.items():
        off = off | ((F.col("split") == s) & (F.abs(F.col("n") / F.col("whole") - share) > 0.01))
    near = by.join(by.agg(F.sum("n").alias("whole")), F.lit(True)).agg((F.count_if(off) == 0).alias("holds"), F.count(F.lit(1)).alias("counted"))
    rules = (("an operator in one split", operators), ("an episode in one split", once), ("shares within one point", near))
    made = [df.select(F.lit(rule).alias("rule"), "holds", "counted") for rule, df in rules]
    return made[0].unionByName(made[1]).unionByName(made[2])


def p7_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of near-identical joint positions as one event."""
    joints = table(spark, sf_dir, "state_joint_position")
    runs = collapse_runs(joints, "episode_path", "row_idx", JOINTS, within=0.001, time="timestamp_ms")
    return runs.withColumn("duration", F.round("duration", 3))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_runs(spark, sf_dir).filter("n_rows >= 10").select("episode_path", "first_row_idx", "last_row_idx")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each evaluation item of which it holds a passage, and how much of it."""
    return leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_tokens(spark: SparkSession, sf_dir: str, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """Tokens of every document, with its source tidied."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", tidy_name(F.col("source")).alias("source"), token_count(F.col("text"), tokenizer_dir).alias("tokens"))


def p9_mix(spark: SparkSession, sf_dir: str, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """How often each document is used in the mix."""
    return mix_sources(p9_tokens(spark, sf_dir, tokenizer_dir), table(spark, sf_dir, "mix_targets"), "tokens")


def p9_shares(spark: SparkSession, sf_dir: str, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """The shares the mix reaches."""
    targets = table(spark, sf_dir, "mix_targets")
    tokens = written(p9_tokens(spark, sf_dir, tokenizer_dir))
    return mix_shares(written(mix_sources(tokens, targets, "tokens")), targets, tokens)


def p9_checks(spark: SparkSession, sf_dir: str, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """Per target source: whether its cap is kept and its share reached within a point."""
    s = p9_shares(spark, sf_dir, tokenizer_dir)
    near = F.abs(F.col("actual_share") - F.col("target_share")) <= 0.01
    return s.select("source", (F.col("most_repeats") <= F.col("max_repeats")).alias("cap_kept"), near.alias("share_reached"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_pairs(table(spark, sf_dir, "documents"))


def p10_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its consistent form."""
    return canonical_documents(table(spark, sf_dir, "documents")).select("doc_id", "canonical")


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its consistent form and its number of look-alikes."""
    return look_alike_classes(table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = (p2_found, p7_found, p8_found, p10_found)
    more = (p2_pairs, p5_percentiles, p5_combined_days, p6_splits, p6_report, p6_checks, p7_runs, p8_leaks, p9_mix, p9_shares, p9_checks, p10_canonical, p10_classes)
    return {f.__name__: f for f in (*found, *more)}


def oracle_sql() -> dict:
    from tallyrig.llm import oracles

    return oracles.SQL | {"p5_percentiles": oracles.percentiles(QUANTILES), "p5_combined_days": oracles.combined(QUANTILES)}
