"""Session helpers: table access, and intermediate tables in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Intermediate tables that are still there.
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share.

    A cluster names it in ``spark.checkpoint.dir``; without that setting only a
    session on this machine alone (a ``local`` master) gets a temporary folder.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyrig-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it from there.

    This cuts the lineage and survives the loss of executors.  Later steps read
    only the columns they need.  ``release`` removes the tables, at the latest
    when the program ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyrig-{uuid.uuid4().hex}"
    _written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)



def release() -> None:
    """Remove all intermediate tables.

    To be called when the results of the queries that wrote them have been used;
    a long session fills the shared folder otherwise.
    """
    while _written:
        spark, path = _written.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass


atexit.register(release)


#: Bytes of source files whose rows go to one partition of a shuffle.
PARTITION_BYTES = 64 << 20


def partitions_for(*frames: DataFrame) -> int:
    """How many partitions a shuffle of ``frames`` should have.

    At least ``spark.sql.shuffle.partitions``; more where the files behind the
    frames are larger than that many partitions should hold.  Sources of unknown
    size (such as rows made in the program) do not count.
    """
    size = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            bytes_ = int(str(leaves.apply(i).stats().sizeInBytes()))
            size += bytes_ if bytes_ < 1 << 60 else 0
    return max(int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
