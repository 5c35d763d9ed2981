"""Composed jobs, streaming, and independence from the input's partitioning."""

import re

import pytest
from pyspark.sql import functions as F

from compare import normal
from headway.operators import metrics, products, spatial
from headway.operators.windows import trip_windows
from headway.plans import features, inference, jobs, model
from headway.session import scratch_path
from headway.sources import tables
from headway.sources.tables import CATALOG, TableStore
from headway.streaming import incidents as si
from headway.streaming import windows as sw
from headway.suite.standins import SCHEMAS, StandIns

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return StandIns(spark, SF)


def rows(df):
    return sorted((tuple(normal(v) for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["windows", "incidents", "metrics", "panel", "nearest"])
def test_result_does_not_depend_on_partitioning(spark, t, name):
    stops = t.stop_times.join(t.stops, "stop_id")
    jobs = {
        "windows": lambda f: trip_windows(f(t.pings), "hour"),
        "incidents": lambda f: spatial.incident_features(f(t.order_windows), f(t.incidents)),
        "metrics": lambda f: metrics.weighted_metrics(f(t.scored), "actual_occupancy_mode", "predicted_occupancy_mode"),
        "panel": lambda f: metrics.daily_metrics(f(t.monitor)),
        "nearest": lambda f: spatial.nearest_trip(f(t.requests), f(stops)),
    }
    job = jobs[name]
    assert rows(job(lambda d: d)) == rows(job(lambda d: d.repartition(13))) == rows(job(lambda d: d.coalesce(1)))


def test_run_day_stores_windows_and_features(spark, t):
    store = TableStore(spark, scratch_path(spark, "day"))
    out = features.run_day(store, t.pings, t.incidents, t.weather, t.holidays)
    first = out.count()
    assert first == store.read(CATALOG["vehicle_trip_agg_fg"]).count() > 0
    names = [f.name for f in features.COMBINED_SCHEMA.fields]
    assert set(names) == set(out.columns)
    again = features.run_day(store, t.pings, t.incidents, t.weather, t.holidays)
    assert again.count() == first


def test_forecast_covers_every_trip_hour_and_day(spark, t):
    trips = t.routes.withColumnRenamed("route_id", "trip_id")
    out = inference.trip_forecast(trips, t.weather, t.holidays, "2024-01-10")
    n = trips.count()
    assert out.count() == n * 19 * 2
    assert {r["hour"] for r in out.select("hour").distinct().collect()} == set(range(5, 24))
    assert {r["weekday"] for r in out.select("weekday").distinct().collect()} == {2, 3}
    located = inference.trip_forecast(
        trips, t.weather, t.holidays, "2024-01-10", lambda d: model.rule_scorer(d).withColumn("confidence", F.col("lat_mean")),
        stop_centres=trips.select("trip_id", F.lit(57.0).alias("lat"), F.lit(15.0).alias("lon")),
    )
    assert {r["confidence"] for r in located.select("confidence").distinct().collect()} == {57.0}


def test_published_forecasts_are_not_sorted_again(spark, t, monkeypatch):
    trips, plans = t.routes.withColumnRenamed("route_id", "trip_id"), []
    store = TableStore(spark, scratch_path(spark, "forecast"))
    monkeypatch.setattr(tables, "write_partitioned", lambda df, *_, **how: plans.append((df._jdf.queryExecution().executedPlan().toString(), how)))
    monkeypatch.setattr(TableStore, "_publish", lambda *_: None)
    centres = trips.select("trip_id", F.lit(57.0).alias("lat"), F.lit(15.0).alias("lon"))
    monkeypatch.setattr(tables.NullCounts, "check", lambda self: None)
    for options in ({}, {"stop_centres": centres.unionByName(centres)}):
        jobs.publish_forecast(store, trips, t.weather, t.holidays, "2024-01-10", **options)
    by_slot = [re.search(r"windowspecdefinition\(\w+#\d+, hour#", plan) is not None for plan, _ in plans]
    assert by_slot == [False, True] and all(how == {"gather": False} for _, how in plans)


def test_grid_has_the_four_corners(spark):
    box = spark.createDataFrame([(56.0, 58.0, 14.0, 17.0)], "min_lat double, max_lat double, min_lon double, max_lon double")
    points = products.grid_points(box)
    assert points.count() == 2000
    corners = points.filter(F.col("lat").isin(56.0, 58.0) & F.col("lon").isin(14.0, 17.0))
    assert corners.count() == 4


def test_heatmap_has_one_row_per_slot(spark, t):
    days = spark.sql("select explode(array(date'2024-01-05', date'2024-01-06')) date")
    box = spatial.stop_bounds(t.stops)
    out = inference.heatmap(days, box.select("min_lat", "max_lat", "min_lon", "max_lon"), t.weather, t.holidays, lat_steps=3, lon_steps=4)
    assert out.count() == 38 and out.select("hour", "weekday").distinct().count() == 38


def test_missing_features_are_named(spark):
    with pytest.raises(model.MissingFeatures, match="max_speed"):
        model.ordered_features(spark.sql("select 1 trip_id"))


def test_forecast_rows_are_made_in_all_tasks(spark):
    """The trips of a forecast are few bytes, which would end in one task, the rows made of them many."""
    trips = spark.range(400).selectExpr("CAST(id % 200 AS STRING) AS trip_id", "'r' AS route_short_name", "CAST(id AS STRING) AS route_long_name")
    spine = products.forecast_spine(trips, inference.forecast_days("2024-01-10", spark))
    dealt = spine.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct("trip_id").alias("trips")).collect()
    assert len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r["trips"] for r in dealt) == 200
    assert all(r["n"] == 38 * r["trips"] for r in dealt)


def test_feature_list():
    assert len(model.FEATURES) == 23 and not set(model.FEATURES) & set(model.NOT_FEATURES)


def test_stream_equals_batch_on_closed_windows(spark, t):
    pings = sw.read_stream(spark, SF, SCHEMAS["events"], "events.parquet")
    stream = _Stream(spark, SF, pings).pings
    path = scratch_path(spark, "stream")
    sw.drain_to_files(sw.stream_windows(stream, "1 hour"), path, scratch_path(spark, "state"))
    got = spark.read.parquet(path)
    edge = t.table("events").agg((F.max("ts") - F.expr("interval 10 minutes")).alias("w")).first()["w"]
    want = t.windows.filter(F.col("window_start") + F.expr("interval 1 hour") <= F.lit(edge))
    columns = ["trip_id", "window_start", "vehicle_id", "n_positions", "lat_mean", "occupancy_mode", "date", "hour"]
    assert rows(got.select(columns)) == rows(want.select(columns)) and got.count() > 100


def test_stream_of_a_placeholder_trip(spark):
    """Most pings name one trip and thousands of vehicles; no state may hold a map of them."""
    folder = scratch_path(spark, "pings")
    pings = spark.range(20_000).selectExpr(
        "timestamp_seconds(1700000000 + id) AS timestamp", "if(id % 10 < 7, 'none', concat('t', id % 40)) AS trip_id", "concat('v', id * 31 % 2000) AS vehicle_id",
        "CAST(if(id % 9 = 0, null, id % 50) AS DOUBLE) / 10 AS speed", "CAST(56 + id % 100 / 100 AS DOUBLE) AS position_lat", "14.5D AS position_lon",
        "CAST(id % 360 AS DOUBLE) AS bearing", "if(id % 5 = 0, null, CAST(id % 7 AS INT)) AS occupancy_status")
    pings.write.parquet(folder)
    stream = sw.stream_windows(spark.readStream.schema(pings.schema).parquet(folder), "1 hour")
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "mode(" not in plan and "collect_" not in plan
    path = scratch_path(spark, "stream")
    sw.drain_to_files(stream, path, scratch_path(spark, "state"))
    got = spark.read.parquet(path)
    edge = F.timestamp_seconds(F.lit(1700000000 + 19_999 - 600))
    want = trip_windows(pings, "hour").filter(F.col("window_start") + F.expr("interval 1 hour") <= edge)
    doubles = [f.name for f in want.schema.fields if f.dataType.typeName() == "double"]
    plain = lambda df: rows(df.withColumns({c: F.round(c, 7) for c in doubles}).select(want.columns))
    assert set(got.columns) == set(want.columns) and plain(got) == plain(want) and got.filter("trip_id = 'none'").count() == 5


def test_stream_incidents_equal_batch_in_any_order_of_arrival(spark):
    """Windows land before and after the incidents of their time, over several batches; borders of time count."""
    day = 86_400
    windows = spark.range(600).selectExpr(
        "concat('t', id) AS trip_id", f"timestamp_seconds(1700000000 + id * {day // 4}) AS window_start",
        "if(id % 37 = 0, null, 56.65 + id % 7 / 400D) AS lat_mean", "14.61 + id % 5 / 400D AS lon_mean")
    incidents = spark.range(80).selectExpr(
        "concat('e', id) AS event_id", "concat('d', id % 9) AS deviation_id", f"timestamp_seconds(1700000000 + id * 2 * {day}) AS start_time",
        f"timestamp_seconds(1700000000 + (id * 2 + id % 90) * {day}) AS end_time", "56.65 + id % 7 / 400D AS latitude", "14.61 + id % 5 / 400D AS longitude",
        "if(id % 4 = 0, 'high', CAST(id % 6 AS STRING)) AS severity_code", "if(id % 3 = 0, null, concat('road ', id % 8)) AS affected_road")
    windows = windows.withColumns({c: F.col(c).cast("double") for c in ("lat_mean", "lon_mean")})
    incidents = incidents.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})
    left, right, path, state = (scratch_path(spark, x) for x in ("w", "i", "pairs", "state"))
    span = F.unix_timestamp("window_start") - 1700000000
    for step in range(4):  # the first windows come before any incident, the last incidents after their windows
        windows.filter(F.floor(span / (40 * day)) == step).write.mode("append").parquet(left)
        began = F.floor((F.unix_timestamp("start_time") - 1700000000) / (40 * day))
        incidents.filter(began == step - 1 if step < 3 else began >= 2).write.mode("append").parquet(right)
        pairs = si.stream_incident_pairs(
            spark.readStream.schema(windows.schema).parquet(left), spark.readStream.schema(incidents.schema).parquet(right), lateness="60 days")
        sw.drain_to_files(pairs, path, state)
    edge = F.lit(min(windows.agg(F.max("window_start")).first()[0], incidents.agg(F.max("start_time")).first()[0])) - F.expr("INTERVAL 60 DAYS")
    got = si.features_of_pairs(spark.read.schema(pairs.schema).parquet(path).filter(F.col("window_start") < edge))
    want = spatial.incident_features(windows, incidents).filter(F.col("window_start") < edge).select(got.columns)
    assert rows(got) == rows(want) and got.count() > 300 and 50 < got.filter("num_nearby_traffic_events > 0").count() < got.count()


def test_stream_incidents_store_no_row_for_each_pair(spark):
    """A busy place: every window is near all incidents of its time, and leaves with their sums and roads."""
    left, right, path = (scratch_path(spark, x) for x in ("w", "i", "pairs"))
    day = 86_400
    windows = spark.range(61).selectExpr("if(id = 60, 'last', concat('t', id % 50)) AS trip_id", f"timestamp_seconds(if(id = 60, {300 * day}, {120 * day} + id % 50)) AS window_start",
                                         "if(id = 7, null, 57.0D) AS lat_mean", "15.0D AS lon_mean")
    incidents = spark.range(201).selectExpr(
        "concat('e', id) AS event_id", "'d' AS deviation_id", f"timestamp_seconds(if(id = 200, 300, 60 + id % 60) * {day}) AS start_time",
        f"timestamp_seconds(if(id = 200, 301, 140) * {day}) AS end_time", "57.0D AS latitude", "15.0D AS longitude",
        "if(id % 2 = 0, null, CAST(id % 6 AS STRING)) AS severity_code", "if(id % 4 = 0, null, concat('road ', id % 4)) AS affected_road")
    windows.write.parquet(left)
    incidents.write.parquet(right)
    pairs = si.stream_incident_pairs(spark.readStream.schema(windows.schema).parquet(left), spark.readStream.schema(incidents.schema).parquet(right))
    sw.drain_to_files(pairs, path, scratch_path(spark, "state"))
    stored = spark.read.schema(pairs.schema).parquet(path).filter("trip_id <> 'last'")
    assert stored.count() <= 60 * 3
    got, want = si.features_of_pairs(stored), spatial.incident_features(windows, incidents).filter("trip_id <> 'last'").select(*si.features_of_pairs(stored).columns).distinct()
    # ten keys come twice: the stream adds up their rows, as the batch does
    assert rows(got) == rows(want) and got.filter("num_nearby_traffic_events = 200").count() == 41 and got.filter("num_nearby_traffic_events = 400").count() == 9


def test_stream_incidents_stop_at_one_that_outlasts_the_state(spark):
    left, right = scratch_path(spark, "w"), scratch_path(spark, "i")
    spark.sql("SELECT 't' AS trip_id, timestamp'2024-01-01' AS window_start, 56.0D AS lat_mean, 14.0D AS lon_mean").write.parquet(left)
    incidents = spark.sql("""SELECT 'e' AS event_id, 'd' AS deviation_id, timestamp'2024-01-01' AS start_time, timestamp'2024-12-31' AS end_time,
        56.0D AS latitude, 14.0D AS longitude, '1' AS severity_code, 'r' AS affected_road""")
    incidents.write.parquet(right)
    pairs = si.stream_incident_pairs(spark.readStream.schema(spark.read.parquet(left).schema).parquet(left), spark.readStream.schema(incidents.schema).parquet(right))
    with pytest.raises(Exception, match="longer than 100 days: e"):
        sw.drain_to_files(pairs, scratch_path(spark, "pairs"), scratch_path(spark, "state"))


def test_stream_upserts_survive_a_restart(spark, t):
    store, spec, state = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"], scratch_path(spark, "state")
    counts = []
    for _ in range(2):
        pings = _Stream(spark, SF, sw.read_stream(spark, SF, SCHEMAS["events"], "events.parquet")).pings
        sw.start_upserts(sw.stream_windows(pings, "1 hour"), store, spec, state).awaitTermination()
        counts.append(store.read(spec).count())
    assert counts[0] == counts[1] > 100


class _Stream(StandIns):
    def __init__(self, spark, sf, events):
        super().__init__(spark, sf)
        self._events = events

    def table(self, name):
        return self._events
