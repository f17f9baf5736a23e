"""Reading episode folders: discovery, documents, streams, manifests, references, videos.

Many small files are read once and written to Parquet; everything after works
on tables.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrig.functions.exprs import number

METADATA = (
    "task_key string, episode_index int, duration_seconds double, total_frames long, fps_actual double, fps_config double,"
    " robot string, controller string, controller_type string, username string, quality struct<labels: array<string>>,"
    " modalities map<string, struct<type: string, frames: long, rows: long, hz: double, frequency: double, hz_nominal: double>>,"
    " frame_integrity map<string, struct<frame_count: long, total_drops: long, max_consecutive_drops: long>>"
)
_EPISODE = r"^(.*?/episode_[^/]*)(?:/|$)"


def entries(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Files and folders below ``roots``, empty ones too: ``path, length, modified, is_dir``.

    The roots are on a file system mounted on all executors; each task walks
    some of the folders directly below them.
    """
    tops = []
    for root in roots:
        root = root.rstrip("/")
        tops += [(f"{root}/{e.name}",) for e in sorted(os.scandir(root), key=lambda e: e.name)]

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for top in part["top"]:
                names = [(top, os.path.isdir(top))]
                for folder, inner, files in os.walk(top):
                    names += [(f"{folder}/{n}", True) for n in inner] + [(f"{folder}/{n}", False) for n in files]
                for name, is_dir in names:
                    info = os.stat(name)
                    found.append((name, info.st_size, pd.Timestamp(info.st_mtime, unit="s").floor("us"), is_dir))
            yield pd.DataFrame(found, columns=["path", "length", "modified", "is_dir"])

    schema = "path string, length long, modified timestamp, is_dir boolean"
    if not tops:
        return spark.createDataFrame([], schema)
    folders = spark.createDataFrame(tops, "top string").repartition(max(1, min(len(tops), 1000)))
    return folders.mapInPandas(walk, schema)


def listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Files below ``roots``, empty ones too: ``path, length, modified``."""
    return entries(spark, roots).filter(~F.col("is_dir")).drop("is_dir")


def discover_episodes(spark: SparkSession, roots: list[str]) -> tuple[DataFrame, DataFrame]:
    """Episode folders below ``roots`` in order, and the hidden folders that were passed over.

    Folders named ``_quarantine`` are left out; those that start with a dot too,
    but they are reported.  An episode is the outermost folder ``episode_*``,
    also if nothing is in it.
    """
    found = entries(spark, roots).select(F.when(F.col("is_dir"), F.concat("path", F.lit("/"))).otherwise(F.col("path")).alias("path"))
    episode = F.regexp_extract("path", r"^(.*?/episode_[^/]*)/", 1)
    hidden = F.regexp_extract("path", r"^(.*?/\.[^/]+)/", 1)
    good = found.filter((hidden == "") & ~F.col("path").contains("/_quarantine/")).select(episode.alias("episode_path")).filter("episode_path <> ''")
    skipped = found.select(hidden.alias("hidden_path")).filter("hidden_path <> ''")
    return good.distinct().orderBy("episode_path"), skipped.distinct().orderBy("hidden_path")


def episode_list(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a text file; blank lines and lines that start with # are no paths."""
    lines = spark.read.text(path).select(F.trim("value").alias("episode_path"))
    return lines.filter((F.col("episode_path") != "") & ~F.col("episode_path").startswith("#"))


def read_metadata(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Each episode's document: ``episode_path, raw, error, document``.

    ``error`` is null, ``missing``, ``invalid_json`` or ``not_an_object``.
    """
    found, _ = discover_episodes(spark, roots)
    texts = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").text(roots, wholetext=True)
        .select(F.regexp_extract(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/"), _EPISODE, 1).alias("episode_path"), F.col("value").alias("raw"))
    )
    rows = found.join(texts, "episode_path", "left")
    kind = F.expr("schema_of_variant(try_parse_json(raw))")
    error = F.when(F.col("raw").isNull(), "missing").when(kind.isNull(), "invalid_json").when(~kind.startswith("OBJECT"), "not_an_object")
    return rows.select("episode_path", "raw", error.alias("error"), F.when(error.isNull(), F.from_json("raw", METADATA)).alias("document"))


def read_streams(spark: SparkSession, roots: list[str], name: str = "data.csv") -> DataFrame:
    """All cells of stream files in long form: ``episode_path, modality, row_idx, column, value``.

    Row order is the file's, so each file is read as one text and its lines are
    numbered.  Cells that are no number, and cells a short row lacks, are null;
    NaN and infinities stay.  Files without data rows give nothing.
    """
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(roots, wholetext=True)
    lines = files.select(
        F.regexp_extract(path, _EPISODE, 1).alias("episode_path"),
        F.element_at(F.split(path, "/"), -2).alias("modality"),
        F.split(F.regexp_replace(F.regexp_replace("value", r"^﻿", ""), r"(\r?\n)+$", ""), r"\r?\n").alias("lines"),
    )
    rows = lines.select(
        "episode_path", "modality", F.split(F.get("lines", F.lit(0)), ",").alias("names"),
        F.posexplode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("row_idx", "line"),
    )
    cells = rows.withColumn("cells", F.split("line", ",")).select(
        "episode_path", "modality", F.col("row_idx").cast("long").alias("row_idx"), F.posexplode("names").alias("at", "column"), "cells"
    )
    return cells.select("episode_path", "modality", "row_idx", F.trim("column").alias("column"), number(F.get("cells", F.col("at"))).alias("value"))


def manifest_findings(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Findings about checksum manifests (``episode_path, raw``) against a listing (``path, length``).

    Broken or unsafe manifests, and listed files that are absent or empty.
    """
    parsed = manifests.select("episode_path", F.from_json("raw", "map<string, string>").alias("m"))
    keys = F.map_keys("m")
    unsafe = F.exists(keys, lambda k: k.startswith("/") | k.contains(".."))
    digest = F.exists(F.map_values("m"), lambda v: v.isNull() | ~v.rlike("^([0-9a-fA-F]{32}|[0-9a-fA-F]{64})$"))
    bad = F.col("m").isNull() | (F.size(keys) == 0) | unsafe | digest
    finding = lambda name, severity: [F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), F.lit("fail").alias("status")]
    broken = parsed.filter(bad).select("episode_path", *finding("checksum_manifest_invalid", "critical"), F.lit(None).cast("string").alias("path"))
    listed = parsed.filter(~bad).select("episode_path", F.explode(keys).alias("name")).withColumn("path", F.concat_ws("/", "episode_path", "name"))
    seen = listed.join(files.select("path", "length"), "path", "left")
    absent = seen.filter("length IS NULL").select("episode_path", *finding("checksum_manifest_file_missing", "critical"), "path")
    empty = seen.filter("length = 0").select("episode_path", *finding("checksum_manifest_file_empty", "major"), "path")
    return broken.unionByName(absent).unionByName(empty)


def hash_mismatches(spark: SparkSession, manifests: DataFrame, roots: list[str]) -> DataFrame:
    """Listed files whose content has another digest, or that cannot be read: ``path, expected, actual``.

    Only the listed files below ``roots`` are read, each by the task that checks
    it, in pieces.  ``actual`` is null for a file that cannot be read; absent files
    are for ``manifest_findings``.
    """
    listed = manifests.select("episode_path", F.explode(F.from_json("raw", "map<string, string>")).alias("name", "expected"))
    listed = listed.select(F.concat_ws("/", "episode_path", "name").alias("path"), F.lower("expected").alias("expected"))
    below = F.lit(False)
    for root in roots:
        below = below | F.col("path").startswith(root.rstrip("/") + "/")

    @F.pandas_udf("string")
    def digest(paths: pd.Series, expected: pd.Series) -> pd.Series:
        def of(path: str, known: str) -> str | None:
            made = hashlib.md5() if len(known) == 32 else hashlib.sha256()
            try:
                with open(path, "rb") as file:
                    while piece := file.read(1 << 20):
                        made.update(piece)
            except FileNotFoundError:
                return known  # a finding of its own
            except OSError:
                return None
            return made.hexdigest()

        return pd.Series([of(p, e) for p, e in zip(paths, expected)], dtype="object")

    some = listed.filter(below & F.col("expected").isNotNull()).repartition("path").withColumn("actual", digest("path", "expected"))
    return some.filter(F.col("actual").isNull() | (F.col("actual") != F.col("expected"))).select("path", "expected", "actual")


def device_reference(spark: SparkSession, path: str) -> DataFrame:
    """Tasks and their devices from a JSON or CSV file: ``task, device``."""
    rows = spark.read.json(path, multiLine=True) if path.endswith(".json") else spark.read.csv(path, header=True)
    return rows.select(F.col("task").cast("string"), F.col("device").cast("string")).filter("task IS NOT NULL AND task <> ''")


def device_reference_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The same from a database by JDBC; filters and columns are pushed to it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select("task", "device")


Decoder = Callable[[bytes], tuple[float, list[tuple[int, np.ndarray]]]]
FRAME_STATS = (
    "path string, opened boolean, frame_count long, fps double, width int, height int, sample_idx int, frame_index long,"
    " brightness double, diff_prev double, lap_var double, tenengrad double, hist array<float>"
)


def frame_stats(videos: DataFrame, decoder: Decoder) -> DataFrame:
    """Numbers of sampled frames of ``videos`` (``path, content``).

    ``decoder`` gives the rate and the sampled frames (index and an RGB array)
    of a video's bytes; none is built in.  A video it fails on is one row that
    is not opened.
    """

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FRAME_STATS.split(", ")]
        for part in parts:
            out = []
            for path, content in part[["path", "content"]].itertuples(index=False, name=None):
                try:
                    fps, samples = decoder(content)
                except Exception:  # noqa: BLE001  any failure of a decoder means: cannot be opened
                    out.append((path, False, *[None] * 11))
                    continue
                before = None
                for k, (index, frame) in enumerate(samples):
                    stats = image_stats(frame, before)
                    out.append((path, True, len(samples), fps, frame.shape[1], frame.shape[0], k, index, *stats))
                    before = frame
            yield pd.DataFrame(out, columns=names)

    return videos.select("path", "content").mapInPandas(read, FRAME_STATS)


def image_stats(frame: np.ndarray, before: np.ndarray | None) -> tuple:
    """Brightness, change, Laplacian variance, Tenengrad and a colour histogram of an RGB frame."""
    gray = frame.astype(float) @ np.array([0.299, 0.587, 0.114])
    pad = np.pad(gray, 1, mode="reflect")
    around = pad[:-2, 1:-1] + pad[2:, 1:-1] + pad[1:-1, :-2] + pad[1:-1, 2:]
    laplace = around - 4 * gray
    sx = (pad[:-2, 2:] + 2 * pad[1:-1, 2:] + pad[2:, 2:]) - (pad[:-2, :-2] + 2 * pad[1:-1, :-2] + pad[2:, :-2])
    sy = (pad[2:, :-2] + 2 * pad[2:, 1:-1] + pad[2:, 2:]) - (pad[:-2, :-2] + 2 * pad[:-2, 1:-1] + pad[:-2, 2:])
    cells = (frame // 64).astype(int)
    hist = np.bincount((cells[..., 0] * 16 + cells[..., 1] * 4 + cells[..., 2]).ravel(), minlength=64)
    change = None if before is None or before.shape != frame.shape else float(np.abs(frame.astype(float) - before).mean())
    return (float(gray.mean()), change, float(laplace.var()), float((sx**2 + sy**2).mean()), (hist / hist.sum()).astype("float32").tolist())


def video_findings(stats: DataFrame, settings: dict) -> DataFrame:
    """Findings about each video from its sampled frames."""
    s = settings
    a = stats.groupBy("path").agg(
        F.bool_or("opened").alias("opened"), F.count("brightness").alias("n"),
        F.count_if(F.col("brightness") < s["black"]).alias("black"), F.count_if(F.col("brightness") > s["white"]).alias("white"),
        F.max("diff_prev").alias("change"), F.avg((F.col("diff_prev") < s["still"]).cast("double")).alias("still"), F.median("lap_var").alias("sharp"),
    )
    rules = [
        ("video_not_openable", "critical", "fail", ~F.col("opened")),
        ("video_black_frames", "critical", "fail", F.col("black") * 2 > F.col("n")),
        ("video_black_frames", "major", "needs_review", (F.col("black") > 0) & (F.col("black") * 2 <= F.col("n"))),
        ("video_white_frames", "critical", "fail", F.col("white") * 2 > F.col("n")),
        ("video_white_frames", "major", "needs_review", (F.col("white") > 0) & (F.col("white") * 2 <= F.col("n"))),
        ("video_frozen", "major", "fail", F.col("change") < s["frozen"]),
        ("view_still", "major", "fail", F.col("still") > s["still_share"]),
        ("video_defocused", "minor", "warning", F.col("sharp") < s["focus"]),
    ]
    from tallyrig.plans.selection import emit

    return emit(a, rules, key="path")
