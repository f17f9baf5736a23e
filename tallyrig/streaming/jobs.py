"""Streams of episode events: ingest, windows, stability, consecutive failures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyrig.operators.store import Store, enqueue

EVENT = "event string, version int, event_id string, try_count int, payload string, received_at timestamp"
#: Where an event's payload may name the episode, in this order.
PATH_KEYS = ("verified_path", "path", "episode_path", "nas_verified_path")


def event_stream(spark: SparkSession, folder: str, files: int = 100) -> DataFrame:
    """Events that arrive as JSON files; a message bus gives the same columns."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files).json(folder)


def event_paths(events: DataFrame, root: str = "/") -> DataFrame:
    """One row for each path an event names; paths outside ``root`` or with ``..`` are dropped."""
    single = F.coalesce(*[F.nullif(F.get_json_object("payload", f"$.{k}"), F.lit("")) for k in PATH_KEYS])
    many = F.from_json(F.get_json_object("payload", "$.verified_paths"), "array<string>")
    paths = F.when(single.isNotNull(), F.array(single)).otherwise(F.coalesce(many, F.array().cast("array<string>")))
    rows = events.withColumn("mounted_path", F.explode(paths))
    inside = F.col("mounted_path").startswith(root) & ~F.col("mounted_path").rlike(r"(^|/)\.\.(/|$)")
    return rows.filter(inside)


def ingest(events: DataFrame, store: Store, checkpoint: str, root: str = "/") -> StreamingQuery:
    """Adds jobs for new paths; repeated events and paths change no job's state.

    A batch that is run again after a failure gives the same table.
    """
    named = event_paths(events, root).select(
        "mounted_path", "event_id", F.get_json_object("payload", "$.record_id").alias("record_id"), F.col("payload").alias("payload_json"), "received_at"
    )
    write = named.writeStream.foreachBatch(lambda batch, _: enqueue(store, batch)).option("checkpointLocation", checkpoint)
    return write.trigger(availableNow=True).start()


def split_failures(events: DataFrame, handler: Callable[[DataFrame], DataFrame], done: str, retry: str, dead: str, checkpoint: str, tries: int = 3) -> StreamingQuery:
    """Runs ``handler`` (adds ``ok``) over each batch and writes what failed to be tried again, or to the dead letters."""

    def run(batch: DataFrame, number: int) -> None:
        out = handler(batch).persist()
        good = F.coalesce(F.col("ok"), F.lit(False))
        # A folder a batch, so a batch that is run again replaces what it wrote.
        out.filter(good).drop("ok").write.mode("overwrite").json(f"{done}/batch={number}")
        again = F.col("try_count") + 1 < tries
        out.filter(~good & again).withColumn("try_count", F.col("try_count") + 1).drop("ok").write.mode("overwrite").json(f"{retry}/batch={number}")
        out.filter(~good & ~again).drop("ok").write.mode("overwrite").json(f"{dead}/batch={number}")
        out.unpersist()

    return events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each kind in tumbling windows of event time; later ones than ``late`` are dropped."""
    return events.withWatermark("received_at", late).groupBy(F.window("received_at", length), "event").agg(F.count(F.lit(1)).alias("n"))


def stable_paths(snapshots: DataFrame, wait_ms: int = 60_000) -> DataFrame:
    """Paths whose (files, bytes, newest) did not change between two snapshots: ``path, state``.

    ``state`` is stable, or timeout where no second snapshot came in time.
    """

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"path": [key[0]], "state": ["timeout"]})
            return
        seen = state.get if state.exists else None
        for part in parts:
            for row in part.sort_values("at")[["files", "bytes", "newest"]].itertuples(index=False, name=None):
                now = tuple(int(x) for x in row)
                if seen is not None and now == tuple(seen):
                    state.remove()
                    yield pd.DataFrame({"path": [key[0]], "state": ["stable"]})
                    return
                seen = now
        state.update(seen)
        state.setTimeoutDuration(wait_ms)

    return snapshots.groupBy("path").applyInPandasWithState(
        follow, "path string, state string", "files long, bytes long, newest long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


STREAK = "task string, robot string, operator string, episode_start int, episode_end int, streak_length int"


def streak_alerts(results: DataFrame, least: int = 5) -> DataFrame:
    """Announces each group's run of bad episodes with consecutive numbers as soon as it is long enough, and as it grows.

    ``results`` has ``task, robot, operator, number, bad`` in the order of their
    arrival; a good episode or a missing number ends a run.  The state of a group
    is two numbers.
    """

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, end = state.get if state.exists else (0, -1)
        grown = False
        for part in parts:
            for number, bad in part.sort_values("number")[["number", "bad"]].itertuples(index=False, name=None):
                if not bad:
                    start, end = 0, -1
                elif end >= start and number == end + 1:
                    end, grown = int(number), True
                elif not (start <= number <= end):
                    start, end, grown = int(number), int(number), True
        state.update((start, end))
        if grown and end - start + 1 >= least:
            yield pd.DataFrame([(*key, start, end, end - start + 1)], columns=[c.split()[0] for c in STREAK.split(", ")])

    return results.groupBy("task", "robot", "operator").applyInPandasWithState(
        follow, STREAK, "start int, finish int", "append", GroupStateTimeout.NoTimeout
    )


def merge_streaks(history: DataFrame, detected: DataFrame, least: int = 5) -> DataFrame:
    """The streak history after a detection.

    ``history`` has ``task, robot, operator, episode_start, episode_end, resolved``;
    ``detected`` the first five.  A streak that starts where an open one does
    extends it.  The part of a streak that resolved ones cover from its start is
    skipped; what is left opens a new one if it is still ``least`` long.  A group
    has one row a streak, which is few, so groups are folded one by one.
    """
    keys = ["task", "robot", "operator"]
    columns = [*keys, "episode_start", "episode_end", "resolved"]
    both = history.select(*columns, F.lit(False).alias("new")).unionByName(
        detected.select(*keys, "episode_start", "episode_end", F.lit(False).alias("resolved"), F.lit(True).alias("new"))
    )

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        kept = part[~part["new"]]
        name = tuple(part[keys].iloc[0])
        rows = [list(r) for r in kept[["episode_start", "episode_end", "resolved"]].itertuples(index=False, name=None)]
        for start, end in part[part["new"]].sort_values("episode_start")[["episode_start", "episode_end"]].itertuples(index=False, name=None):
            moved = True
            while moved:
                moved = False
                for s, e, resolved in rows:
                    if resolved and s <= start <= e:
                        start, moved = e + 1, True
            if end - start + 1 < least:
                continue
            same = next((r for r in rows if r[0] == start and not r[2]), None)
            if same is not None:
                same[1] = max(same[1], end)
            else:
                rows.append([start, end, False])
        return pd.DataFrame([(*name, *r) for r in rows], columns=columns)

    return both.groupBy(*keys).applyInPandas(fold, "task string, robot string, operator string, episode_start int, episode_end int, resolved boolean")
