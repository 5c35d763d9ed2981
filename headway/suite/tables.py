"""Keyed tables: scans, upserts, checks and versions, on tables written for the run."""

from pyspark.sql import functions as F

from headway.operators import metrics
from headway.session import scratch_path
from headway.sources.tables import CATALOG, TableStore, write_partitioned
from headway.suite.registry import query

_TS = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"


@query("table_scan", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'""")
def table_scan(t):
    day = F.col("o_orderdate")
    start, end = (F.lit(d).cast("timestamp") for d in ("1998-01-01", "1998-02-01"))
    return t.table("orders").filter((day >= start) & (day < end)).select("o_orderkey", "o_totalprice")


def _stored_windows(t, store):
    store.upsert(CATALOG["vehicle_trip_agg_fg"], t.windows)
    return store.read(CATALOG["vehicle_trip_agg_fg"])


@query("table_spec", """SELECT 'vehicle_trip_agg_fg' AS name, 2::BIGINT AS version, 'trip_id,window_start' AS keys, 'window_start' AS event_time, count(*) AS n_rows FROM windows""")
def table_spec(t):
    """Declared table with its identity and the rows it holds."""
    spec = CATALOG["vehicle_trip_agg_fg"]
    stored = _stored_windows(t, TableStore(t.spark, scratch_path(t.spark, "tables")))
    return stored.agg(F.count("*").alias("n_rows")).select(
        F.lit(spec.name).alias("name"), F.lit(spec.version).alias("version"), F.lit(",".join(spec.keys)).alias("keys"),
        F.lit(spec.event_time).alias("event_time"), "n_rows",
    )


@query("keyed_upsert", """SELECT trip_id, CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS weekday, CAST(n_positions AS BIGINT) AS n_positions FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_id, hour, day_of_week ORDER BY window_start DESC) AS rn FROM windows) WHERE rn = 1""")
def keyed_upsert(t):
    """Two batches, the newer month half first; the later event time must win either way."""
    store, spec = TableStore(t.spark, scratch_path(t.spark, "tables")), CATALOG["forecast_fg"]
    rows = t.windows.select(
        "trip_id", "hour", F.col("day_of_week").alias("weekday"), "n_positions", F.col("window_start").alias("generated_at"), "date"
    )
    middle = F.lit("2024-01-16").cast("date")
    store.upsert(spec, rows.filter(F.col("date") >= middle))
    store.upsert(spec, rows.filter(F.col("date") < middle))
    return store.read(spec).select("trip_id", "hour", "weekday", "n_positions")


@query("verify_written", """SELECT CAST(date AS VARCHAR) AS date, count(*) AS n_rows FROM windows GROUP BY windows.date QUALIFY dense_rank() OVER (ORDER BY windows.date DESC) <= 5
    UNION ALL SELECT '2024-12-24', 0""")
def verify_written(t):
    store = TableStore(t.spark, scratch_path(t.spark, "tables"))
    _stored_windows(t, store)
    return store.rows_per_day(CATALOG["vehicle_trip_agg_fg"], "window_start", "2024-12-24")


@query("partition_write", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS feed_date, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def partition_write(t):
    """Written by quarter of a year, read back with the date inside."""
    path = scratch_path(t.spark, "shapes")
    rows = t.table("orders").select(
        F.to_date("o_orderdate").alias("feed_date"), "o_totalprice", F.date_format(F.date_trunc("quarter", "o_orderdate"), "yyyy-MM-dd").alias("feed_quarter")
    )
    write_partitioned(rows, path, "feed_quarter")
    write_partitioned(rows, path, "feed_quarter")
    back = t.spark.read.parquet(path)
    return back.groupBy("feed_date").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("not_null_gate", f"SELECT trip_id, {_TS}, vehicle_id FROM windows")
def not_null_gate(t):
    return metrics.not_null_gate(t.windows, ["trip_id", "window_start"]).select("trip_id", "window_start", "vehicle_id")


@query("null_counts", """SELECT count(*) FILTER (trip_id IS NULL) AS trip_id, count(*) FILTER (speed IS NULL) AS speed, count(*) FILTER (occupancy_status IS NULL) AS occupancy_status FROM pings""")
def null_counts(t):
    return metrics.null_counts(t.pings, ["trip_id", "speed", "occupancy_status"])


@query("version_fallback", f"SELECT trip_id, {_TS} FROM windows")
def version_fallback(t):
    """Version 2 exists but is empty, version 1 holds the rows."""
    store, spec = TableStore(t.spark, scratch_path(t.spark, "tables")), CATALOG["vehicle_trip_agg_fg"]
    store.write(spec, t.windows, version=1)
    store.write(spec, t.windows.filter("false"))
    return store.newest_with_rows(spec, [2, 1]).select("trip_id", "window_start")
