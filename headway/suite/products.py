"""Spines, forecasts, hindcast and map products, scored by the time-of-day rule."""

from pyspark.sql import functions as F

from headway.operators import products, spatial
from headway.operators.enrich import trip_dim
from headway.plans import inference
from headway.suite.registry import query

_RULE = """CASE WHEN (hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18) THEN CASE WHEN is_work_free OR is_red_day THEN 1 WHEN hour < 8 OR hour > 17 THEN 2 ELSE 3 END
    WHEN hour BETWEEN 10 AND 15 THEN 1 ELSE 0 END"""

# the two newest dates of the events stand for today and tomorrow
_DAYS = "SELECT DISTINCT CAST(ts AS DATE) AS date FROM events QUALIFY dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) <= 2"
_SLOTS = f"""SELECT d.date, CAST(h AS INTEGER) AS hour, CAST(isodow(d.date) - 1 AS INTEGER) AS weekday, d.date::TIMESTAMP + to_hours(h::INTEGER) AS window_start
    FROM ({_DAYS}) d CROSS JOIN range(5, 24) r(h)"""
_SLOT_FLAGS = f"""SELECT s.*, coalesce(is_work_free, false) AS is_work_free, coalesce(is_red_day, false) AS is_red_day FROM ({_SLOTS}) s LEFT JOIN holidays USING (date)"""
_MAP_FLAGS = f"""SELECT s.*, coalesce(is_work_free, isodow(date) >= 6) AS is_work_free, coalesce(is_red_day, isodow(date) = 7) AS is_red_day FROM ({_SLOTS}) s LEFT JOIN holidays USING (date)"""
_BOX = "SELECT min(stop_lat) - 0.02::DOUBLE AS min_lat, max(stop_lat) + 0.02::DOUBLE AS max_lat, min(stop_lon) - 0.02::DOUBLE AS min_lon, max(stop_lon) + 0.02::DOUBLE AS max_lon FROM stops"


def last_days(t):
    return t.table("events").select(F.to_date("ts").alias("date")).distinct().orderBy(F.col("date").desc()).limit(2)


def today(t):
    """First of the two newest dates: the forecast covers exactly those two."""
    return last_days(t).agg(F.min("date")).first()[0]


def stop_box(t):
    return spatial.stop_bounds(t.stops).select("min_lat", "max_lat", "min_lon", "max_lon")


@query("forecast_spine", f"""SELECT trip_id, route_short_name, route_long_name, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(date AS VARCHAR) AS date,
    CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday FROM (SELECT DISTINCT c_custkey AS trip_no, CAST(c_custkey AS VARCHAR) AS trip_id, c_mktsegment AS route_short_name, c_name AS route_long_name FROM customer) CROSS JOIN ({_SLOTS})""")
def forecast_spine(t):
    trips = t.routes.withColumnRenamed("route_id", "trip_id")
    return products.forecast_spine(trips, last_days(t))


@query("trip_forecast", f"""SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday,
    CAST({_RULE} AS BIGINT) AS predicted_occupancy, 0.6::DOUBLE AS confidence, route_short_name
    FROM (SELECT trip_id, route_short_name FROM trips LEFT JOIN routes USING (route_id)) CROSS JOIN ({_SLOT_FLAGS})""")
def trip_forecast(t):
    trips = trip_dim(t.trips, t.routes, t.agency, check=False)
    found = inference.trip_forecast(trips, t.weather, t.holidays, today(t), generated_at="2024-01-30 10:30:00")
    return found.drop("generated_at", "route_long_name")


@query("hindcast", """SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, trip_id, CAST(actual AS BIGINT) AS actual_occupancy_mode, CAST(predicted AS BIGINT) AS predicted_occupancy_mode,
    round(accuracy, 7) AS accuracy, round("precision", 7) AS "precision", round(recall, 7) AS recall, round(f1_weighted, 7) AS f1_weighted, round(mae, 7) AS mae,
    4::BIGINT AS model_version, '2024-01-30 10:30:00' AS generated_at FROM scored JOIN day_quality USING (date) WHERE date = DATE '2024-01-20'""")
def hindcast(t):
    return inference.hindcast(t.windows, t.weather, t.holidays, "2024-01-20", generated_at="2024-01-30 10:30:00")


@query("grid_spine", f"""SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, lat_id, lon_id, round(min_lat + lat_id * ((max_lat - min_lat) / 39), 7) AS lat,
    round(min_lon + lon_id * ((max_lon - min_lon) / 49), 7) AS lon FROM ({_SLOTS}) CROSS JOIN ({_BOX}) CROSS JOIN range(40) a(lat_id) CROSS JOIN range(50) b(lon_id)""")
def grid_spine(t):
    cells = products.grid_spine(products.service_hours(last_days(t)), stop_box(t))
    return cells.select("hour", "weekday", "lat_id", "lon_id", "lat", "lon")


@query("slot_class_counts", f"SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, CAST({_RULE} AS BIGINT) AS class, 2000 AS n_cells FROM ({_MAP_FLAGS})")
def slot_class_counts(t):
    cells = inference.grid_forecast(last_days(t), stop_box(t), t.weather, t.holidays)
    return products.slot_class_counts(cells)


@query("grid_forecast", f"""SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, lat_id, lon_id, CAST({_RULE} AS BIGINT) AS predicted_occupancy
    FROM ({_MAP_FLAGS}) CROSS JOIN range(40) a(lat_id) CROSS JOIN range(50) b(lon_id)""")
def grid_forecast(t):
    cells = inference.grid_forecast(last_days(t), stop_box(t), t.weather, t.holidays)
    return cells.select("hour", "weekday", "lat_id", "lon_id", "predicted_occupancy")


_MIX = "CASE occupancy_mode WHEN 0 THEN NULL ELSE 'c' || occupancy_mode || ':' || n END"


@query("slot_summary", f"""SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, CAST(sum(n) AS BIGINT) AS n_cells, coalesce(string_agg({_MIX}, ', ' ORDER BY occupancy_mode), 'all class 0') AS mix
    FROM (SELECT hour, day_of_week AS weekday, occupancy_mode, count(*) AS n FROM windows WHERE occupancy_mode IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def slot_summary(t):
    cells = t.windows.filter(F.col("occupancy_mode").isNotNull()).select(
        "hour", F.col("day_of_week").alias("weekday"), F.col("occupancy_mode").alias("predicted_occupancy")
    )
    return products.slot_summary(products.slot_class_counts(cells))


def _ordinate(base: str, sign: str, step: str) -> str:
    return f"CAST({base} {sign} {step} / 2 AS VARCHAR)"


_W, _E = _ordinate("lon", "-", "lon_step"), _ordinate("lon", "+", "lon_step")
_S, _N = _ordinate("lat", "-", "lat_step"), _ordinate("lat", "+", "lat_step")
_RING = " || ',' || ".join(f"'[' || {x} || ',' || {y} || ']'" for x, y in ((_W, _S), (_E, _S), (_E, _N), (_W, _N), (_W, _S)))
_COLOR = "CASE pred WHEN 1 THEN '#84cc16' WHEN 2 THEN '#eab308' WHEN 3 THEN '#f97316' ELSE '#22c55e' END"


@query("slot_geojson", f"""SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, '{{"type":"FeatureCollection","features":[' || string_agg(
    '{{"type":"Feature","properties":{{"color":"' || {_COLOR} || '","fillOpacity":0.35,"pred_class":' || pred || '}},"geometry":{{"type":"Polygon","coordinates":[[' || {_RING} || ']]}}}}',
    ',' ORDER BY lat_id, lon_id) || ']}}' AS geojson
    FROM (SELECT hour, weekday, lat_id, lon_id, {_RULE} AS pred, min_lat + lat_id * ((max_lat - min_lat) / 39) AS lat, min_lon + lon_id * ((max_lon - min_lon) / 49) AS lon,
          (max_lat - min_lat) / 39 AS lat_step, (max_lon - min_lon) / 49 AS lon_step
          FROM ({_MAP_FLAGS}) CROSS JOIN ({_BOX}) CROSS JOIN range(40) a(lat_id) CROSS JOIN range(50) b(lon_id)) GROUP BY 1, 2""")
def slot_geojson(t):
    cells = inference.grid_forecast(last_days(t), stop_box(t), t.weather, t.holidays, lat_steps=40, lon_steps=50)
    return products.slot_geojson(cells)


@query("slot_sink", f"""SELECT CAST(hour AS BIGINT) AS hour, CAST(weekday AS BIGINT) AS weekday, 2000 AS n_features, CAST({_RULE} AS BIGINT) AS first_class, '2024-01-30 10:30:00' AS generated_at FROM ({_MAP_FLAGS})""")
def slot_sink(t):
    rows = inference.heatmap(last_days(t), stop_box(t), t.weather, t.holidays, generated_at="2024-01-30 10:30:00")
    feature = "features array<struct<properties:struct<pred_class:int>>>"
    parsed = rows.withColumn("g", F.from_json("geojson", feature))
    return parsed.select(
        "hour", "weekday", F.size("g.features").alias("n_features"),
        F.col("g.features")[0]["properties"]["pred_class"].alias("first_class"), "generated_at",
    )


@query("stamped_append", f"SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderpriority, '2024-01-30 10:30:00' AS generated_at FROM orders")
def stamped_append(t):
    rows = t.table("orders").select(F.col("o_orderkey").alias("trip_id"), "o_orderpriority")
    return products.stamped(rows, "2024-01-30 10:30:00")


@query("slot_json_roundtrip", "SELECT CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS weekday, CAST(sum(n_positions) AS VARCHAR) AS geojson FROM windows GROUP BY windows.hour, day_of_week")
def slot_json_roundtrip(t):
    slots = t.windows.groupBy("hour", F.col("day_of_week").alias("weekday")).agg(F.sum("n_positions").cast("string").alias("geojson"))
    return products.map_to_slots(products.slots_to_map(slots))
