"""A result store of versioned Parquet tables with keyed writes.

A write makes a new version beside the current one; a version counts once its
success marker is there, so readers never see half a write and a failed job
leaves the table as it was.  Old versions go when told to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Store:
    """Tables below one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        files = folder.getFileSystem(conf)
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            part = status.getPath().getName()
            if part.startswith("version=") and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(int(part.split("=")[1]))
        return sorted(found)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def read(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """The current version; an empty table of ``schema`` where there is none."""
        versions = self._versions(name)
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{name}/version={versions[-1]}")

    def write(self, name: str, df: DataFrame, keep: int = 2) -> None:
        versions = self._versions(name)
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/version={(versions[-1] if versions else 0) + 1}")
        for old in versions[: -max(keep - 1, 1)]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/version={old}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def upsert(self, name: str, new: DataFrame, keys: list[str], order: str) -> None:
        """New rows replace those of the same key; within ``new`` the greatest ``order`` counts."""
        rest = [c for c in new.columns if c not in keys]
        newest = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("n")).select(*keys, "n.*").select(*new.columns)
        old = self.read(name, new.schema)
        self.write(name, old.join(newest, keys, "left_anti").select(*new.columns).unionByName(newest))

    def replace(self, name: str, new: DataFrame, scope: DataFrame, keys: list[str]) -> None:
        """All rows whose ``keys`` are in ``scope`` give way to ``new``, also where ``new`` has none."""
        old = self.read(name, new.schema)
        self.write(name, old.join(scope.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(new))

    def prune(self, name: str, keep: DataFrame, key: str, always: str = "false") -> None:
        """Only rows of kept keys stay, and those for which ``always`` holds."""
        old = self.read(name)
        marked = old.join(keep.select(key).distinct().withColumn("__k", F.lit(True)), key, "left")
        self.write(name, marked.filter(F.coalesce(F.col("__k"), F.lit(False)) | F.expr(always)).select(*old.columns))


JOBS = (
    "mounted_path string, event_id string, record_id string, payload_json string, status string, attempts int,"
    " error string, received_at timestamp, updated_at timestamp"
)


def enqueue(store: Store, events: DataFrame) -> None:
    """Adds jobs for events (``mounted_path, event_id, record_id, payload_json, received_at``).

    A path or an event that is known only refreshes its payload; its state stays.
    """
    old = store.read("jobs", JOBS)
    new = events.filter("mounted_path IS NOT NULL AND event_id IS NOT NULL")
    # A path once, by its latest event; then an event once, by its first path.
    new = new.groupBy("mounted_path").agg(F.max_by(F.struct("event_id", "record_id", "payload_json", "received_at"), F.struct("received_at", "event_id")).alias("e")).select("mounted_path", "e.*")
    new = new.groupBy("event_id").agg(F.min(F.struct("mounted_path", "record_id", "payload_json", "received_at")).alias("e")).select("event_id", "e.*")
    known = old.join(new.select("mounted_path", F.col("payload_json").alias("p"), F.col("received_at").alias("r")), "mounted_path", "left")
    refreshed = known.withColumn("payload_json", F.coalesce("p", "payload_json")).withColumn("updated_at", F.coalesce("r", "updated_at")).select(*old.columns)
    fresh = new.join(old.select("mounted_path"), "mounted_path", "left_anti").join(old.select("event_id"), "event_id", "left_anti").select(
        "mounted_path", "event_id", "record_id", "payload_json", F.lit("pending").alias("status"), F.lit(0).alias("attempts"),
        F.lit(None).cast("string").alias("error"), "received_at", F.col("received_at").alias("updated_at"),
    )
    store.write("jobs", refreshed.unionByName(fresh))


def transition(store: Store, outcomes: DataFrame, retries: int = 3) -> None:
    """Applies outcomes (``mounted_path, outcome, error, at``): started, done, failed, skipped, recovered.

    A failed job is to be retried until it was started ``retries`` times.
    """
    jobs = store.read("jobs", JOBS)
    latest = outcomes.groupBy("mounted_path").agg(F.max_by(F.struct("outcome", "error", "at"), "at").alias("o")).select("mounted_path", "o.outcome", F.col("o.error").alias("new_error"), "o.at")
    both = jobs.join(latest, "mounted_path", "left")
    o, s = F.col("outcome"), F.col("status")
    attempts = F.col("attempts") + F.when((o == "started") & s.isin("pending", "retry"), 1).otherwise(0)
    status = (
        F.when((o == "started") & s.isin("pending", "retry"), "running")
        .when((o == "done") & (s == "running"), "done")
        .when((o == "failed") & (s == "running"), F.when(F.col("attempts") < retries, "retry").otherwise("failed"))
        .when(o == "skipped", "skipped")
        .when((o == "recovered") & (s == "running"), "retry")
        .otherwise(s)
    )
    store.write(
        "jobs",
        both.select(
            *[c for c in jobs.columns if c not in ("status", "attempts", "error", "updated_at")],
            status.alias("status"), attempts.alias("attempts"), F.coalesce("new_error", "error").alias("error"), F.coalesce("at", "updated_at").alias("updated_at"),
        ).select(*jobs.columns),
    )


def retention(files: DataFrame, days: int, count: int, size: int) -> DataFrame:
    """Which files (``path, length, modified``) go: by age, number and total size, newest first."""
    newest = Window.orderBy(F.desc("day"))
    daily = files.groupBy(F.to_date("modified").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"))
    daily = daily.select("day", (F.sum("n").over(newest) - F.col("n")).alias("before"), (F.sum("b").over(newest) - F.col("b")).alias("bytes"))
    by = Window.partitionBy("day").orderBy(F.desc("modified"), "path")
    rows = files.withColumn("day", F.to_date("modified")).join(daily, "day")
    rows = rows.withColumn("k", F.col("before") + F.row_number().over(by)).withColumn("total", F.col("bytes") + F.sum("length").over(by))
    last = files.agg(F.max(F.to_date("modified")).alias("last"))
    reason = F.when(F.date_diff("last", "day") > days, "age").when(F.col("k") > count, "count").when(F.col("total") > size, "size").otherwise("keep")
    return rows.join(F.broadcast(last), F.lit(True)).select("path", reason.alias("reason"))  # one row
