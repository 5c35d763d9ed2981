"""Keyed, versioned Parquet tables.

A table is a folder <root>/<name>_v<version> of appended runs: run=<number>/<partition>=<value>. Readers take
the newest row of each key, by event time, then by run, so an upsert reads and rewrites nothing that is there
and running it twice gives the same table. The partition is a value that the key determines: filters on it
reach the files. A run is written aside and appears by one rename, so a job that dies leaves the table as it
was. `compact` replaces the runs by one that holds the newest rows. A table has one writer at a time.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.metrics import NullCounts
from headway.operators.windows import STATE_KEYS, first_per_key


@dataclass(frozen=True)
class TableSpec:
    """Declaration of a table: identity, key, event time, expectations and layout."""

    name: str
    version: int
    keys: tuple[str, ...]
    event_time: str | None
    partition: str
    # SQL expression over key columns that gives the partition value
    partition_expr: str
    description: str = ""
    not_null: tuple[str, ...] = field(default=())
    # key column whose rows stay together from task to file and meet in one exchange; no value of it may hold a large share of the rows
    cluster: str | None = None

    @property
    def folder(self) -> str:
        return f"{self.name}_v{self.version}"


# Table names, versions, keys and event times (all but the partial windows).
CATALOG = {
    s.name: s
    for s in [
        TableSpec("vehicle_trip_agg_fg", 2, ("trip_id", "window_start"), "window_start", "date", "to_date(window_start)",
                  "1 minute trip windows", ("trip_id", "window_start")),
        TableSpec("vehicle_trip_state_fg", 1, (*STATE_KEYS, "ping_run"), None, "date", "to_date(window_start)",
                  "partial windows per vehicle, occupancy and run", ("trip_id", "window_start")),
        TableSpec("weather_hourly_fg", 1, ("timestamp", "latitude", "longitude"), "timestamp", "day", "to_date(timestamp)",
                  "hourly weather"),
        TableSpec("swedish_holidays_fg", 1, ("date",), "date", "year", "year(date)", "holidays per day"),
        TableSpec("trafikverket_traffic_event_fg", 2, ("event_id", "deviation_id"), "start_time", "bucket",
                  "pmod(xxhash64(event_id), 64)", "road incidents"),
        TableSpec("combined_features_daily", 1, ("trip_id", "window_start"), "window_start", "date", "to_date(window_start)",
                  "windows with incidents, weather and holidays"),
        TableSpec("static_trip_info_fg", 1, ("trip_id", "feed_date"), None, "feed_date", "feed_date", "trips per feed", cluster="trip_id"),
        TableSpec("static_trip_and_stops_info_fg", 1, ("trip_id", "stop_sequence", "feed_date"), None, "feed_date", "feed_date",
                  "stops of trips per feed", cluster="trip_id"),
        TableSpec("forecast_fg", 2, ("trip_id", "hour", "weekday"), "generated_at", "weekday", "weekday", "trip forecasts",
                  cluster="trip_id"),
        TableSpec("monitor_fg", 2, ("window_start", "trip_id"), "generated_at", "day", "to_date(window_start)", "hindcast results"),
        TableSpec("heatmap_geojson_fg", 3, ("hour", "weekday"), "generated_at", "weekday", "weekday", "map cells per slot"),
        TableSpec("merged_fg", 1, ("trip_id",), "window_start", "bucket", "pmod(xxhash64(trip_id), 64)", "joined training rows"),
    ]
}


# stored bytes that one task of a read of a clustered table takes
CLUSTER_BYTES = 4 << 20


def spec_rows(spark: SparkSession) -> DataFrame:
    """The catalogue as a table."""
    rows = [(s.name, s.version, ",".join(s.keys), s.event_time, s.partition) for s in CATALOG.values()]
    return spark.createDataFrame(rows, "name string, version int, keys string, event_time string, partition string")


class TableStore:
    """Reads and writes catalogued tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, spec: TableSpec, version: int | None = None) -> str:
        return f"{self.root}/{spec.name}_v{version or spec.version}"

    def _runs(self, spec: TableSpec, version: int | None = None) -> DataFrame | None:
        """All rows of all runs, or None when nothing was written yet."""
        path = self.path(spec, version)
        if not self._files(path).globStatus(self._path(f"{path}/run=*")):
            return None
        # a later run may have further columns
        return self.spark.read.option("basePath", path).option("mergeSchema", True).parquet(path)

    def read(self, spec: TableSpec, version: int | None = None, only: DataFrame | None = None) -> DataFrame | None:
        """The newest row of each key, or None when nothing was written yet; with `only` those of its partition values."""
        runs = self._runs(spec, version)
        if runs is None:
            return None
        if only is not None:
            runs = runs.join(only.select(spec.partition).distinct(), spec.partition, "left_semi")
        if spec.cluster:
            path = self.path(spec, version)
            stored = self._files(path).getContentSummary(self._path(path)).getLength()
            runs = runs.repartition(max(stored // CLUSTER_BYTES + 1, self.spark.sparkContext.defaultParallelism), spec.cluster)
        # the key determines the partition; named with it, filters on the partition pass below the choice
        return first_per_key(runs, [*spec.keys, spec.partition], [*_newest(spec), F.col("run").desc()]).drop("run")

    def newest_with_rows(self, spec: TableSpec, versions: list[int]) -> DataFrame | None:
        """First of the given versions that holds rows."""
        for version in versions:
            table = self.read(spec, version)
            if table is not None and not table.isEmpty():
                return table
        return None

    def upsert(self, spec: TableSpec, batch: DataFrame, run: int | None = None, distinct: bool = False) -> int:
        """Insert or replace by key; the later event time wins, then the later run. Returns the number of the run.

        One pass over the batch: it counts nulls of required columns, keeps one row per key and writes it. A
        run that names its number replaces an earlier run of that number. A batch whose keys are `distinct` by
        construction is written as it comes.
        """
        counts = NullCounts(list(spec.not_null), spec.folder)
        rows = counts.watch(batch.withColumn(spec.partition, F.expr(spec.partition_expr)))
        if distinct:
            return self.write(spec, rows, run, counts)
        rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in spec.keys and _orderable(rows, c)]
        return self.write(spec, first_per_key(rows, list(spec.keys), [*_newest(spec), *rest]), run, counts)

    def write(self, spec: TableSpec, df: DataFrame, run: int | None = None, counts: NullCounts | None = None, version: int | None = None) -> int:
        """Append the rows as a run; it becomes visible when all of it is there and its null counts are clean."""
        run, path = run or time.time_ns() // 1000, self.path(spec, version)
        staged = f"{path}/.staged-{run}"
        write_partitioned(df, staged, spec.partition, gather=spec.cluster is None)
        if counts is not None:
            try:
                counts.check()
            except ValueError:
                self._files(path).delete(self._path(staged), True)
                raise
        self._publish(staged, f"{path}/run={run}")
        return run

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self, text: str):
        return self._path(text).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _publish(self, staged: str, folder: str) -> None:
        files = self._files(folder)
        files.delete(self._path(folder), True)
        if not files.globStatus(self._path(f"{staged}/*=*")):  # no rows, no run
            files.delete(self._path(staged), True)
        elif not files.rename(self._path(staged), self._path(folder)):
            raise OSError(f"{staged} could not become {folder}")

    def touched(self, spec: TableSpec, run: int) -> DataFrame:
        """Partition values that a run has rows in; only folder names are read."""
        path, folder = self.path(spec), f"{self.path(spec)}/run={run}"
        if not self._files(folder).exists(self._path(folder)):
            return self.spark.createDataFrame([], f"{spec.partition} string")
        return self.spark.read.option("basePath", path).parquet(folder).select(spec.partition).distinct()

    def compact(self, spec: TableSpec) -> None:
        """Replace all runs by one with the newest row of each key. Readers that began before need to start again."""
        runs = self._runs(spec)
        if runs is None:
            return
        last = runs.agg(F.max("run")).first()[0]
        path = self.path(spec)
        old = [s.getPath() for s in self._files(path).listStatus(self._path(path)) if s.getPath().getName().startswith("run=")]
        # its number is above those it replaces and below that of any later run
        self.write(spec, self.read(spec), last + 1)
        for folder in old:
            self._files(path).delete(folder, True)

    def rows_per_day(self, spec: TableSpec, instant: str, day=None, last: int = 5) -> DataFrame:
        """Row counts of the newest days, and of the wanted day even when it has none.

        In a table partitioned by that day the folders name the days, and only those that count are read.
        """
        table, date = self.read(spec), F.to_date(instant)
        wanted_day = F.lit(day).cast("date")
        if spec.partition_expr == f"to_date({instant})":
            date = F.col(spec.partition)
            newest = [F.lit(r[0]) for r in self._runs(spec).select(date).distinct().orderBy(date.desc()).limit(last).collect()]
            table = table.filter(date.isin(*newest, *([] if day is None else [wanted_day])))
        counts = table.groupBy(date.alias("date")).agg(F.count("*").alias("n_rows"))
        recent = counts.orderBy(F.col("date").desc()).limit(last)
        if day is None:
            return recent
        wanted = table.filter(date == wanted_day).agg(wanted_day.alias("date"), F.count("*").alias("n_rows"))
        return recent.unionByName(wanted).distinct()


def _newest(spec: TableSpec) -> list[Column]:
    return [F.col(spec.event_time).desc_nulls_last()] if spec.event_time else []


def _orderable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def write_partitioned(df: DataFrame, path: str, column: str, gather: bool = True) -> None:
    """Write below <column>=<value> folders, replacing only the values at hand.

    Rebalancing gathers each value into few files and splits a value that
    holds a large share of the rows over several tasks. Without `gather` every
    task writes its own rows: for frames of few values.
    """
    (df.hint("rebalance", column) if gather else df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
