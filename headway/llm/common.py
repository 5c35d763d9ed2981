"""Shared helpers of the operators: sessions, tables, words, temporary column names."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import prepare, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# rows and bytes of one Arrow batch; texts can be long, so batches stay small
BATCH_ROWS, BATCH_BYTES = "512", "4000000"
# a word is a run of anything but blank, tab and the four line controls
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None):
    """Register `fn(spark, sf_dir)` under `name`, with its SQL where there is one."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; bytes.split() knows exactly the six separators of WORD."""
    return text.split() if text else []


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of `df`, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text: Column) -> Column:
    """128 bits of a text, as hex; null stays apart from every text."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit("-"))


def keep_rows(docs: DataFrame, kept: DataFrame, once: bool = False) -> DataFrame:
    """The rows of `docs` whose (doc_id, text) is in `kept`, which has the columns doc_id and text_md5.

    Null ids and null texts match themselves. Repeated rows stay repeated, or with `once` become one.
    """
    key, = fresh(docs, "row_key")
    named = lambda doc_id, md5: F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), md5).cast("binary"))
    wanted = kept.select(named(F.col("doc_id"), F.col("text_md5")).alias(key)).distinct()
    found = docs.withColumn(key, named(F.col("doc_id"), text_key(F.col("text")))).join(wanted, key, "left_semi")
    return (found.dropDuplicates([key]) if once else found).select([F.col(f"`{c}`") for c in docs.columns])


def returning_memory(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`work` as a task that gives its memory back when it ends, as Python workers live on and serve other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library, which has no such call

    return run


class Scratch:
    """Written tables of one job in the shared folder, which it drops as soon as nothing needs them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Lets go of the shuffle files of finished jobs, which otherwise stay until the driver happens to collect garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Deletes tables whose readers have all been written themselves."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.release()
