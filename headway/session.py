"""Session settings and the shared scratch location every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Instants are compared across engines and feeds, so one zone is pinned; the
# rest lets the engine re-plan on real sizes.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when a later step then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a write into few folders keeps a file open for each and sorts no rows; more folders are sorted
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # streams keep their window state on disk instead of on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # a join of streams keeps one store a partition, not four
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_dir()


@cache
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="headway-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing existing is touched."""
    return f"{shared_dir(spark)}/headway/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the shared folder: computed once, safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the table of a frame made by `written`, once nothing reads it any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if f"{shared_dir(df.sparkSession).rpartition(':')[2].lstrip('/')}/headway/" in folder:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
