"""Cleaning operators."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from headway.functions.geo import in_bounds
from headway.operators import cleaning as c
from headway.operators.products import REGION_BOUNDS
from headway.plans import model
from headway.suite.registry import query


@query("clean_columns", "SELECT c_custkey AS customer_key, c_name AS f_2nd_name, c_acctbal AS f_acct_bal FROM customer")
def clean_columns(t):
    return c.clean_columns(
        t.table("customer").select("c_custkey", "c_name", "c_acctbal").toDF(" Customer Key", "2nd Name", "_Acct Bal ")
    )


@query("dedup_columns", "SELECT o_orderkey, o_custkey FROM orders")
def dedup_columns(t):
    o = t.table("orders")
    return c.dedup_columns(o.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("o_orderkey")))


@query("drop_missing", """SELECT feed_entity_id, CAST(occupancy_status AS BIGINT) AS occupancy_status, round(speed, 7) AS speed FROM pings
    WHERE occupancy_status IS NOT NULL AND speed IS NOT NULL""")
def drop_missing(t):
    return c.require_columns(t.pings, ["occupancy_status", "speed"]).select("feed_entity_id", "occupancy_status", "speed")


@query("coerce_numeric", """SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS brand_number, TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_suffix FROM part""")
def coerce_numeric(t):
    texts = t.table("part").select(
        "p_partkey", F.col("p_brand").alias("brand_number"), F.regexp_replace("p_brand", "Brand#", "").alias("brand_suffix")
    )
    return c.coerce_numeric(texts, ["brand_number", "brand_suffix"])


@query("id_to_int", """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE o_custkey END AS trip_id,
    coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT), 0) AS vehicle_id FROM orders""")
def id_to_int(t):
    texts = t.table("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.col("o_custkey").cast("string")).alias("trip_id"),
        F.substring("o_orderpriority", 1, 1).alias("vehicle_id"),
    )
    return c.ids_to_int(texts)


@query("id_to_int_drop", "SELECT o_orderkey, o_custkey AS trip_id FROM orders WHERE o_orderpriority <> '1-URGENT'")
def id_to_int_drop(t):
    texts = t.table("orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "x").otherwise(F.col("o_custkey").cast("string")).alias("trip_id")
    )
    return c.ids_to_int(texts, ["trip_id"], drop_bad=True)


@query("numeric_share", """SELECT col AS "column", filled, numeric, numeric > filled * 0.5 AS convertible FROM (
    SELECT 'trip_id' AS col, count(trip_id) AS filled, count(TRY_CAST(trip_id AS DOUBLE)) AS numeric FROM pings
    UNION ALL SELECT 'vehicle_id', count(vehicle_id), count(TRY_CAST(vehicle_id AS DOUBLE)) FROM pings)""")
def numeric_share(t):
    return c.numeric_share(t.pings.select("trip_id", "vehicle_id"))


_SLIM = StructType([
    StructField("trip_id", StringType()), StructField("n_positions", LongType()), StructField("occupancy_mode", LongType()),
    StructField("max_speed", DoubleType()), StructField("day_of_week", IntegerType()), StructField("weather_code", LongType()),
])


@query("conform_schema", """SELECT trip_id, n_positions, CAST(occupancy_mode AS BIGINT) AS occupancy_mode, round(max_speed, 7) AS max_speed,
    CAST(day_of_week AS BIGINT) AS day_of_week, CAST(NULL AS BIGINT) AS weather_code FROM windows""")
def conform_schema(t):
    return c.conform(t.windows, _SLIM)


_NUMBERS = StructType([
    StructField("trip_id", LongType()), StructField("trip_number", LongType()), StructField("vehicle_id", IntegerType()), StructField("speed", DoubleType()),
    StructField("absent", DoubleType()),
])


@query("conform_misfits", """SELECT count(trip_id) - count(TRY_CAST(trip_id AS BIGINT)) AS trip_id,
    count(trip_number) - count(TRY_CAST(trip_number AS BIGINT)) AS trip_number, count(vehicle_id) - count(TRY_CAST(vehicle_id AS INTEGER)) AS vehicle_id,
    CAST(0 AS BIGINT) AS speed, CAST(0 AS BIGINT) AS absent FROM named_pings""")
def conform_misfits(t):
    """Every named trip is a misfit among numbers; the numbered trips of all pings are cast as well."""
    return c.misfits(t.named_pings, _NUMBERS)


_FILL = """SELECT feed_entity_id, {temp} AS temperature_2m, {wind} AS wind_speed_10m FROM pings"""


@query("fill_defaults", _FILL.format(temp="round(coalesce(speed, 10), 7)", wind="round(coalesce(occupancy_status::DOUBLE, 5), 7)"))
def fill_defaults(t):
    rows = t.pings.select("feed_entity_id", F.col("speed").alias("temperature_2m"), F.col("occupancy_status").cast("double").alias("wind_speed_10m"))
    return c.fill_weather(rows)


@query("fill_falsy", _FILL.format(temp="round(coalesce(nullif(speed, 0), 10), 7)", wind="round(coalesce(nullif(occupancy_status::DOUBLE, 0), 5), 7)"))
def fill_falsy(t):
    rows = t.pings.select("feed_entity_id", F.col("speed").alias("temperature_2m"), F.col("occupancy_status").cast("double").alias("wind_speed_10m"))
    return c.fill_weather(rows, zero_is_missing=True)


@query("median_impute", """WITH tr AS (SELECT * FROM windows WHERE date < DATE '2024-01-24'),
    m AS (SELECT quantile_cont(avg_speed, 0.5) AS ma, quantile_cont(speed_std, 0.5) AS ms FROM tr)
    SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(coalesce(avg_speed, ma), 7) AS avg_speed,
    round(coalesce(speed_std, ms), 7) AS speed_std FROM windows CROSS JOIN m""")
def median_impute(t):
    rows = t.windows.select("trip_id", "window_start", "avg_speed", "speed_std", "date")
    train = rows.filter(F.col("date") < F.lit("2024-01-24").cast("date"))
    return c.impute_medians(train, [rows], ["avg_speed", "speed_std"])[0].drop("date")


@query("default_end_time", """SELECT event_id, strftime(coalesce(CASE WHEN NOT valid_until_further_notice THEN end_time END, start_time + INTERVAL 1 DAY), '%Y-%m-%d %H:%M:%S') AS end_time FROM incidents""")
def default_end_time(t):
    open_ended = t.incidents.withColumn("end_time", F.when(~F.col("valid_until_further_notice"), F.col("end_time")))
    return c.default_end_time(open_ended).select("event_id", "end_time")


@query("null_normalise", """SELECT * FROM (SELECT nullif(nullif(o_orderpriority, '5-LOW'), '') AS trip_id, o_orderkey,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders) WHERE trip_id IS NOT NULL""")
def null_normalise(t):
    dirty = t.table("orders").select(
        F.when(F.col("o_orderpriority") == "5-LOW", "nan").otherwise(F.col("o_orderpriority")).alias("trip_id"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return c.null_normalise(dirty)


@query("bool_to_int", "SELECT CAST(date AS VARCHAR) AS date, is_work_free::BIGINT AS is_work_free, is_red_day::BIGINT AS is_red_day FROM holidays")
def bool_to_int(t):
    return c.flags_to_int(t.holidays.select("date", "is_work_free", "is_red_day"))


@query("feature_select", """SELECT trip_id, vehicle_id, round(max_speed, 7) AS max_speed, n_positions, round(lat_mean, 7) AS lat_mean, round(lon_mean, 7) AS lon_mean,
    round(lat_min, 7) AS lat_min, round(lat_max, 7) AS lat_max, round(lon_min, 7) AS lon_min, round(lon_max, 7) AS lon_max, round(bearing_min, 7) AS bearing_min,
    round(bearing_max, 7) AS bearing_max, CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week FROM windows""")
def feature_select(t):
    return model.select_features(t.windows)


@query("in_bounds", """SELECT stop_id FROM (SELECT stop_id, stop_lat * 1.02::DOUBLE AS lat, stop_lon AS lon FROM stops)
    WHERE lat BETWEEN 56.6414::DOUBLE AND 58.8654::DOUBLE AND lon BETWEEN 14.6144::DOUBLE AND 16.9578::DOUBLE""")
def bounds_filter(t):
    shifted = t.stops.select("stop_id", (F.col("stop_lat") * 1.02).alias("lat"), F.col("stop_lon").alias("lon"))
    return shifted.filter(in_bounds(F.col("lat"), F.col("lon"), REGION_BOUNDS)).select("stop_id")


@query("active_on_day", """SELECT event_id FROM incidents WHERE start_time < TIMESTAMP '1998-06-01 23:59:59'
    AND (end_time > TIMESTAMP '1998-06-01 00:00:00' OR valid_until_further_notice)""")
def active_on_day(t):
    return c.active_on_day(t.incidents, "1998-06-01 00:00:00", "1998-06-01 23:59:59").select("event_id")


_DAY = "SELECT CAST(date AS VARCHAR) AS date, count(*) AS n_rows FROM windows WHERE date = {} GROUP BY windows.date"


@query("day_or_latest", _DAY.format("DATE '2024-01-12'"))
def day_present(t):
    return c.day_or_latest(t.windows, "2024-01-12").groupBy("date").agg(F.count("*").alias("n_rows"))


@query("day_or_latest_fallback", _DAY.format("(SELECT max(date) FROM windows)"))
def day_fallback(t):
    return c.day_or_latest(t.windows, "2030-01-01").groupBy("date").agg(F.count("*").alias("n_rows"))


@query("weather_day_filter", """SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", latitude, temperature_2m FROM weather
    WHERE date >= DATE '2024-01-10' AND date <= least(DATE '2024-01-31', DATE '2024-01-25' - 5)""")
def weather_day_filter(t):
    day = F.col("date")
    span = (day >= F.lit("2024-01-10").cast("date")) & (day <= c.weather_range_end("2024-01-31", "2024-01-25"))
    return t.weather.filter(span).select("timestamp", "latitude", "temperature_2m")
