"""Scalar expressions over whole tables."""

from pyspark.sql import functions as F

from headway.functions import clock, geo
from headway.functions import occupancy as occ
from headway.operators.cleaning import flags_to_int
from headway.operators.enrich import training_set
from headway.suite.registry import query
from headway.suite.standins import BOX_LAT, BOX_LON, haversine_sql, spread, spread_sql


@query("haversine_m", f"""SELECT stop_id, round({haversine_sql('58.41::DOUBLE', '15.62::DOUBLE', 'stop_lat', 'stop_lon', 6371000.0)}, 3) AS metres FROM stops""")
def haversine(t):
    metres = geo.haversine_m(F.lit(58.41), F.lit(15.62), F.col("stop_lat"), F.col("stop_lon"))
    return t.stops.select("stop_id", F.round(metres, 3).alias("metres"))


_WKT_SQL = """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'POINT (' || x || ' ' || y || ')'
    WHEN 1 THEN 'LINESTRING (' || x || ' ' || y || ', ' || (x + 2) || ' ' || (y + 4) || ', ' || (x + 6) || ' ' || y || ')'
    WHEN 2 THEN 'POLYGON ((' || x || ' ' || y || '))' END AS wkt, x, y FROM (SELECT c_custkey, c_custkey % 170 AS x, c_custkey % 80 AS y FROM customer)"""


def wkt_rows(t):
    x, y = F.col("c_custkey") % 170, F.col("c_custkey") % 80
    kind = F.col("c_custkey") % 4
    wkt = (
        F.when(kind == 0, F.format_string("POINT (%d %d)", x, y))
        .when(kind == 1, F.format_string("LINESTRING (%d %d, %d %d, %d %d)", x, y, x + 2, y + 4, x + 6, y))
        .when(kind == 2, F.format_string("POLYGON ((%d %d))", x, y))
    )
    return t.table("customer").select("c_custkey", "c_name", wkt.alias("wkt"))


@query("wkt_centroid", f"""SELECT c_custkey, round(CASE WHEN wkt LIKE 'POINT%' THEN y WHEN wkt LIKE 'LINE%' THEN (y + y + 4 + y)::DOUBLE / 3 END, 7)::DOUBLE AS lat,
    round(CASE WHEN wkt LIKE 'POINT%' THEN x WHEN wkt LIKE 'LINE%' THEN (x + x + 2 + x + 6)::DOUBLE / 3 END, 7)::DOUBLE AS lon FROM ({_WKT_SQL})""")
def wkt_centroid(t):
    return wkt_rows(t).select("c_custkey", geo.wkt_centroid(F.col("wkt")).alias("c")).select("c_custkey", "c.lat", "c.lon")


@query("geometry_pick", f"SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN wkt END, CASE WHEN c_custkey % 5 = 0 THEN wkt END, c_name) AS wkt FROM ({_WKT_SQL}) JOIN customer USING (c_custkey)")
def geometry_pick(t):
    key = F.col("c_custkey")

    def part(condition):
        return F.struct(F.when(condition, F.col("wkt")).alias("WGS84"))

    geometry = F.struct(part(key % 3 == 0).alias("Point"), part(key % 5 == 0).alias("Line"), F.col("c_name").alias("WGS84"))
    return wkt_rows(t).withColumn("g", geometry).select("c_custkey", geo.pick_wkt(F.col("g")).alias("wkt"))


@query("clock_seconds", "SELECT trip_id, stop_id, CAST(arrival_s AS BIGINT) AS seconds FROM stop_times")
def clock_seconds(t):
    return t.stop_times.select("trip_id", "stop_id", clock.clock_seconds(F.col("arrival_time")).alias("seconds"))


@query("tz_shift", """SELECT event_id, strftime((ts AT TIME ZONE 'Europe/Stockholm') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc FROM events""")
def tz_shift(t):
    return t.table("events").select("event_id", clock.local_to_utc(F.col("ts")).alias("utc"))


@query("parse_time", """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 5 <> 0 THEN make_timestamp((1700000000 + o_orderkey) * 1000000) END, '%Y-%m-%d %H:%M:%S') AS instant,
    CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def parse_time(t):
    key = F.col("o_orderkey")
    return t.table("orders").select(
        "o_orderkey",
        clock.epoch_instant(F.when(key % 5 == 0, 0).otherwise(key + 1700000000)).alias("instant"),
        clock.parse_day(F.when(key % 7 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))).alias("day"),
    )


@query("yes_flag", "SELECT o_orderkey, coalesce(o_orderstatus = 'F', false) AS is_work_free, isodow(o_orderdate) - 1 AS day_of_week FROM orders")
def yes_flag(t):
    answer = F.when(F.col("o_orderstatus") == "F", "Ja").when(F.col("o_orderstatus") == "O", "Nej")
    one_based = F.weekday("o_orderdate") + 1
    return t.table("orders").select(
        "o_orderkey", clock.yes_flag(answer).alias("is_work_free"), clock.zero_based_weekday(one_based).alias("day_of_week")
    )


@query("dow_shift", "SELECT event_id, isodow(ts) - 1 AS day_of_week FROM events")
def dow_shift(t):
    monday_is_one = F.weekday("ts") + 1
    return t.table("events").select("event_id", clock.zero_based_weekday(monday_is_one).alias("day_of_week"))


@query("weekend_default", """SELECT CAST(d AS VARCHAR) AS date, coalesce(is_work_free, isodow(d) >= 6) AS is_work_free, coalesce(is_red_day, isodow(d) = 7) AS is_red_day,
    coalesce(is_work_free, false) AS batch_work_free FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) LEFT JOIN holidays ON d = date""")
def weekend_default(t):
    days = t.table("events").select(F.to_date("ts").alias("date")).distinct().join(t.holidays, "date", "left")
    day = F.col("date")
    return days.select(
        "date",
        clock.default_work_free(F.col("is_work_free"), day).alias("is_work_free"),
        clock.default_red_day(F.col("is_red_day"), day).alias("is_red_day"),
        clock.default_work_free(F.col("is_work_free"), day, weekend=False).alias("batch_work_free"),
    )


_DAY_TYPE = "CASE WHEN is_red_day THEN 'Holiday' WHEN is_work_free THEN 'Work-free day' ELSE 'Regular day' END"


@query("day_type", f"SELECT CAST(date AS VARCHAR) AS date, {_DAY_TYPE} AS day_type FROM holidays")
def day_type(t):
    return t.holidays.select("date", occ.day_type(F.col("is_red_day"), F.col("is_work_free")).alias("day_type"))


@query("route_label", """SELECT c_custkey, CASE WHEN s <> '' AND l IS NOT NULL THEN s || ' - ' || l WHEN s <> '' THEN 'Route: ' || s
    WHEN l IS NOT NULL THEN 'Route: ' || l END AS label FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS s,
    CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS l FROM customer)""")
def route_label(t):
    key = F.col("c_custkey")
    short, long_name = F.when(key % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.when(key % 4 != 0, F.col("c_name"))
    return t.table("customer").select("c_custkey", occ.route_label(short, long_name).alias("label"))


@query("conditions_text", f"""SELECT f.trip_id, strftime(f.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
    concat_ws(' | ', CASE WHEN temperature_2m IS NOT NULL THEN CAST(round_even(temperature_2m, 0) AS BIGINT) || '°C' END, CASE WHEN snowfall > 0 THEN 'Snow' END,
    CASE WHEN rain > 1 THEN 'Rain' END, {_DAY_TYPE}, dayname(f.window_start)) AS conditions FROM flagged f LEFT JOIN weather_hour h ON f.window_start = h."timestamp" """)
def conditions_text(t):
    wide = training_set(t.windows, t.weather, t.holidays)
    kind = occ.day_type(F.col("is_red_day"), F.col("is_work_free"))
    text = occ.conditions_text(F.col("temperature_2m"), F.col("snowfall"), F.col("rain") - 1, kind, F.col("window_start"))
    return wide.select("trip_id", "window_start", text.alias("conditions"))


_PROBS = "[(p_partkey % 7)::DOUBLE, (p_partkey * 3 % 7)::DOUBLE, (p_partkey * 5 % 11)::DOUBLE, p_size::DOUBLE / 10]"


@query("argmax_conf", f"""SELECT p_partkey, list_position(p, list_max(p)) - 1 AS predicted, round(list_max(p), 7) AS confidence FROM (SELECT p_partkey, {_PROBS} AS p FROM part)""")
def argmax_conf(t):
    k = F.col("p_partkey")
    p = F.array((k % 7).cast("double"), (k * 3 % 7).cast("double"), (k * 5 % 11).cast("double"), F.col("p_size") / 10)
    return t.table("part").select("p_partkey", occ.top_class(p).alias("predicted"), occ.top_confidence(p).alias("confidence"))


@query("occupancy_dim", """SELECT feed_entity_id, CASE occupancy_status WHEN 0 THEN 'Empty' WHEN 1 THEN 'Many seats available' WHEN 2 THEN 'Few seats available' WHEN 3 THEN 'Standing room only' END AS label,
    CASE occupancy_status WHEN 1 THEN '#84cc16' WHEN 2 THEN '#eab308' WHEN 3 THEN '#f97316' ELSE '#22c55e' END AS color FROM pings""")
def occupancy_dim(t):
    dim = F.broadcast(occ.occupancy_dim(t.spark).select(F.col("class").alias("occupancy_status"), F.col("long_label").alias("label")))
    joined = t.pings.join(dim, "occupancy_status", "left")
    return joined.select("feed_entity_id", "label", occ.class_color(F.col("occupancy_status")).alias("color"))


@query("cell_polygon", """SELECT stop_id, round(stop_lon - 0.02::DOUBLE, 7) AS west, round(stop_lat - 0.01::DOUBLE, 7) AS south, round(stop_lon + 0.02::DOUBLE, 7) AS east,
    round(stop_lat + 0.01::DOUBLE, 7) AS north, true AS closed, 5 AS n_points FROM stops""")
def cell_polygon(t):
    ring = t.stops.withColumn("r", geo.cell_ring(F.col("stop_lat"), F.col("stop_lon"), 0.02, 0.04))
    return ring.select(
        "stop_id", F.col("r")[0][0].alias("west"), F.col("r")[0][1].alias("south"), F.col("r")[2][0].alias("east"),
        F.col("r")[2][1].alias("north"), (F.col("r")[0] == F.col("r")[4]).alias("closed"), F.size("r").alias("n_points"),
    )


@query("linspace", f"""SELECT c_custkey, round({spread_sql('c_custkey', 31, 997, BOX_LAT)} + (c_custkey % 40) * (2.224::DOUBLE / 39), 7) AS lat FROM customer""")
def linspace(t):
    low = spread("c_custkey", 31, 997, BOX_LAT)
    return t.table("customer").select("c_custkey", geo.linspace(F.col("c_custkey") % 40, low, low + 2.224, 40).alias("lat"))


@query("round_distance", f"SELECT stop_id, CAST(round_even({haversine_sql('58.41::DOUBLE', '15.62::DOUBLE', 'stop_lat', 'stop_lon', 6371000.0)}, 0) AS BIGINT) AS metres FROM stops")
def round_distance(t):
    metres = geo.haversine_m(F.lit(58.41), F.lit(15.62), F.col("stop_lat"), F.col("stop_lon"))
    return t.stops.select("stop_id", geo.metres_rounded(metres).alias("metres"))


@query("in_window_s", "SELECT stop_headsign, count(*) FILTER (abs(arrival_s - 43200) <= 3600) AS n_inside, count(*) AS n_rows FROM stop_times GROUP BY 1")
def in_window_s(t):
    inside = clock.within_seconds(clock.clock_seconds(F.col("arrival_time")), F.lit(43200))
    return t.stop_times.groupBy("stop_headsign").agg(F.count_if(inside).alias("n_inside"), F.count("*").alias("n_rows"))


@query("missing_flag_default", """SELECT CAST(d AS VARCHAR) AS date, coalesce(is_work_free, false)::BIGINT AS is_work_free FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) LEFT JOIN holidays ON d = date""")
def missing_flag_default(t):
    days = t.table("events").select(F.to_date("ts").alias("date")).distinct().join(t.holidays, "date", "left")
    return flags_to_int(days.select("date", "is_work_free"))


@query("vertex_level", """SELECT feed_entity_id, CAST(CASE WHEN i > 1 THEN NULL WHEN i >= 0.8 THEN 4 WHEN i >= 0.6 THEN 3 WHEN i >= 0.4 THEN 2 WHEN i >= 0.2 THEN 1 ELSE 0 END AS BIGINT) AS band
    FROM (SELECT feed_entity_id, bearing / 352.8::DOUBLE AS i FROM pings)""")
def vertex_level(t):
    return t.pings.select("feed_entity_id", occ.intensity_band(F.col("bearing") / 352.8).alias("band"))


@query("rule_predictor", "SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(predicted AS BIGINT) AS predicted FROM scored")
def rule_predictor(t):
    return t.scored.select("trip_id", "window_start", F.col("predicted_occupancy_mode").alias("predicted"))


@query("ordinal_chain", """SELECT feed_entity_id, CAST(CASE WHEN (position_lon - 14.6144::DOUBLE) / 0.4::DOUBLE > 0.5 THEN 3 WHEN (position_lat - 56.6414::DOUBLE) / 0.4::DOUBLE > 0.5 THEN 2 WHEN bearing / 360 > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS predicted FROM pings""")
def ordinal_chain(t):
    p1, p2, p3 = F.col("bearing") / 360, (F.col("position_lat") - 56.6414) / 0.4, (F.col("position_lon") - 14.6144) / 0.4
    return t.pings.select("feed_entity_id", occ.ordinal_class(p1, p2, p3).alias("predicted"))
