"""Feed flatteners on landed text that Spark derives from the driver's tables."""

from pyspark.sql import functions as F

from headway.functions.values import blank_to_null
from headway.operators.enrich import WEATHER_MEASURES
from headway.session import scratch_path
from headway.sources import feeds, timetable
from headway.suite.registry import query


def landed_messages(t):
    """One feed message per event: a vehicle entity and an alert entity without one."""
    k = F.get_json_object("props", "$.k").cast("int")
    vehicle = F.struct(
        F.struct(F.col("event_type").alias("trip_id")).alias("trip"),
        F.struct(F.when(k % 10 == 0, "").otherwise(F.col("user_id").cast("string")).alias("id")).alias("vehicle"),
        F.struct(F.lit(58.5).alias("latitude"), F.lit(15.5).alias("longitude"), k.cast("double").alias("bearing"), F.col("value").alias("speed")).alias("position"),
        F.when(k % 7 == 0, 0).otherwise(F.unix_timestamp("ts")).alias("timestamp"),
        F.nullif(k % 5, F.lit(4)).alias("occupancy_status"),
    )
    entity = F.array(
        F.struct(F.col("event_id").cast("string").alias("id"), vehicle.alias("vehicle")),
        F.struct(F.concat(F.lit("alert-"), F.col("event_id")).alias("id"), F.lit(None).cast(vehicle_type()).alias("vehicle")),
    )
    return t.table("events").select(
        F.to_json(F.struct(entity.alias("entity"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.hour("ts").alias("hour"))).alias("value")
    )


def vehicle_type() -> str:
    return (
        "struct<trip:struct<trip_id:string>,vehicle:struct<id:string>,position:struct<latitude:double,longitude:double,"
        "bearing:double,speed:double>,timestamp:bigint,occupancy_status:int>"
    )


@query("flatten_positions", """SELECT CAST(event_id AS VARCHAR) AS feed_entity_id, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS BIGINT) AS hour,
    CASE WHEN k % 7 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS "timestamp", CASE WHEN k % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS vehicle_id,
    event_type AS trip_id, 58.5::DOUBLE AS position_lat, 15.5::DOUBLE AS position_lon, k::DOUBLE AS bearing, value AS speed, CAST(nullif(k % 5, 4) AS BIGINT) AS occupancy_status
    FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)""")
def flatten_positions(t):
    schema = f"{feeds.FEED_MESSAGE}, date string, hour int"
    messages = landed_messages(t).select(F.from_json("value", schema).alias("m")).select("m.*")
    return feeds.flatten_positions(messages)


@query("flatten_positions_files", """SELECT event_type AS trip_id, count(*) AS n_pings FROM events WHERE CAST(props->>'$.k' AS INTEGER) % 10 <> 0 GROUP BY 1""")
def flatten_positions_files(t):
    path = scratch_path(t.spark, "feed")
    parts = landed_messages(t).select("value", F.get_json_object("value", "$.date").alias("date"))
    parts.hint("rebalance", "date").write.partitionBy("date").text(path)
    pings = feeds.flatten_positions(feeds.read_feed_messages(t.spark, path))
    return pings.filter(F.col("vehicle_id").isNotNull()).groupBy("trip_id").agg(F.count("*").alias("n_pings"))


@query("bad_records", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n_lines, count(*) FILTER (event_id % 9 = 0 OR event_id % 11 = 0) AS n_bad
    FROM events GROUP BY 1""")
def bad_records(t):
    """Every ninth line is cut short, every eleventh has a text where a number belongs; none of them is lost."""
    lines = landed_messages(t).withColumn("n", F.get_json_object("value", "$.entity[0].id").cast("bigint"))
    cut = F.when(F.col("n") % 9 == 0, F.expr("left(value, length(value) - 3)")).when(
        F.col("n") % 11 == 0, F.regexp_replace("value", r'"timestamp":\d+', '"timestamp":"soon"')).otherwise(F.col("value"))
    path = scratch_path(t.spark, "feed-bad")
    lines.select(cut.alias("value"), F.get_json_object("value", "$.date").alias("date")).hint("rebalance", "date").write.partitionBy("date").text(path)
    return feeds.bad_records(feeds.read_feed_messages(t.spark, path)).select(F.col("date").cast("string").alias("date"), "n_lines", "n_bad")


@query("hour_coverage", """SELECT CAST(d AS VARCHAR) AS date, 24 - count(*) FILTER (n IS NULL) AS hours_with_data, count(*) FILTER (n IS NULL) AS empty_hours,
    coalesce(string_agg(CASE WHEN n IS NULL THEN CAST(h AS VARCHAR) END, ',' ORDER BY h), '') AS missing_hours
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) CROSS JOIN range(24) r(h)
    LEFT JOIN (SELECT CAST(ts AS DATE) AS d, hour(ts) + CASE WHEN hour(ts) % 5 = 0 THEN 1 ELSE 0 END AS h, count(*) AS n FROM events GROUP BY 1, 2) USING (d, h) GROUP BY 1""")
def hour_coverage(t):
    """Pulls of all events; those of every fifth hour came an hour late."""
    late = F.when(F.hour("ts") % 5 == 0, 1).otherwise(0)
    pulls = t.table("events").select(F.to_date("ts").alias("date"), (F.hour("ts") + late).alias("hour"))
    return feeds.hour_coverage(pulls)


@query("union_hours", "SELECT CAST(ts AS DATE)::VARCHAR AS date, count(*) AS n_rows, count(CASE WHEN hour(ts) < 12 THEN value END) AS n_speed FROM events GROUP BY 1")
def union_hours(t):
    rows = t.table("events").select(F.to_date("ts").alias("date"), F.hour("ts").alias("hour"), F.col("value").alias("speed"))
    morning, evening = rows.filter("hour < 12"), rows.filter("hour >= 12").drop("speed")
    return feeds.union_hours([morning, evening]).groupBy("date").agg(F.count("*").alias("n_rows"), F.count("speed").alias("n_speed"))


@query("zip_columns", """SELECT o_orderkey, o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def zip_columns(t):
    left = t.table("orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey"))
    return left.join(t.table("customer").select("c_custkey", "c_mktsegment"), "c_custkey").drop("c_custkey")


@query("gtfs_static_scan", """SELECT service_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, CAST(monday AS BIGINT) AS monday, CAST(sunday AS BIGINT) AS sunday FROM calendar""")
def gtfs_static_scan(t):
    """Writes the calendar as CSV with its own column order and reads it back."""
    folder = scratch_path(t.spark, "gtfs")
    days = {c: F.date_format(c, "yyyyMMdd") for c in ("start_date", "end_date")}
    out = t.calendar.withColumns(days)
    out.select(*reversed(out.columns)).write.option("header", True).csv(f"{folder}/calendar.txt")
    table = timetable.read_table(t.spark, folder, "calendar")
    return table.select("service_id", "start_date", "end_date", "monday", "sunday")


@query("gtfs_stop_times_scan", """SELECT trip_id, stop_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, arrival_time, departure_time, stop_headsign FROM stop_times""")
def gtfs_stop_times_scan(t):
    folder = scratch_path(t.spark, "gtfs")
    t.stop_times.write.option("header", True).csv(f"{folder}/stop_times.txt")
    return timetable.read_table(t.spark, folder, "stop_times")


@query("shapes_normalise", """SELECT CAST(l_orderkey AS VARCHAR) AS shape_id, CAST(l_linenumber AS BIGINT) AS shape_pt_sequence, round(l_tax + 58, 7) AS shape_pt_lat, round(l_discount + 15, 7) AS shape_pt_lon,
    CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS shape_dist_traveled FROM lineitem""")
def shapes_normalise(t):
    return timetable.normalise_shapes(raw_shapes(t))


def raw_shapes(t):
    """Shape points as text, as the file has them."""

    def text(c):
        return F.col(c).cast("string")

    return t.table("lineitem").select(
        text("l_orderkey").alias("shape_id"), text("l_linenumber").alias("shape_pt_sequence"),
        (F.col("l_tax") + 58).cast("string").alias("shape_pt_lat"), (F.col("l_discount") + 15).cast("string").alias("shape_pt_lon"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(text("l_extendedprice")).alias("shape_dist_traveled"),
    )


def situation_xml(t):
    """One situation per customer with 0 to 2 deviations."""
    n = F.col("c_custkey") % 3

    def deviation(i: int):
        return F.format_string(
            f"<Deviation><Id>%s-{i}</Id><StartTime>2025-12-0%dT10:00:00Z</StartTime><RoadNumber>%s</RoadNumber><SeverityCode>%d</SeverityCode>"
            "<ValidUntilFurtherNotice>%s</ValidUntilFurtherNotice><Geometry><Point><WGS84>POINT (15.%d 58.5)</WGS84></Point></Geometry></Deviation>",
            F.col("c_custkey").cast("string"), (F.col("c_custkey") % 9 + 1).cast("int"), F.col("c_mktsegment"),
            F.col("c_nationkey"), F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false"), F.col("c_nationkey"),
        )

    return t.table("customer").select(
        F.concat(
            F.format_string("<Situation><Id>%s</Id><Deleted>%s</Deleted>", F.col("c_custkey").cast("string"), F.when(F.col("c_acctbal") < 0, "true").otherwise("false")),
            F.when(n >= 1, deviation(1)).otherwise(""), F.when(n >= 2, deviation(2)).otherwise(""), F.lit("</Situation>"),
        ).alias("value")
    )


_SITUATIONS = """SELECT CAST(c_custkey AS VARCHAR) AS event_id, CASE WHEN c_custkey % 3 >= i THEN c_custkey || '-' || i END AS deviation_id, c_acctbal < 0 AS deleted,
    CASE WHEN c_custkey % 3 >= i THEN c_mktsegment END AS affected_road, CASE WHEN c_custkey % 3 >= i THEN CAST(c_nationkey AS VARCHAR) END AS severity_code,
    c_custkey % 3 >= i AND c_custkey % 2 = 0 AS valid_until_further_notice, CASE WHEN c_custkey % 3 >= i THEN 58.5::DOUBLE END AS latitude,
    CASE WHEN c_custkey % 3 >= i THEN CAST('15.' || c_nationkey AS DOUBLE) END AS longitude, '2025-12-10' AS ingestion_date,
    CASE WHEN c_custkey % 3 >= i THEN TIMESTAMP '2025-12-01 10:00:00' + to_days((c_custkey % 9)::INTEGER) END AS start_time
    FROM customer CROSS JOIN range(1, 3) r(i) WHERE i <= greatest(c_custkey % 3, 1)"""
_INCIDENT_COLUMNS = "event_id, deviation_id, deleted, affected_road, severity_code, valid_until_further_notice, latitude, longitude, ingestion_date"


@query("incident_flatten", f"SELECT {_INCIDENT_COLUMNS} FROM ({_SITUATIONS})")
def incident_flatten(t):
    flat = feeds.flatten_incidents(feeds.parse_situations(situation_xml(t), "value"), "2025-12-10")
    return flat.select(*_INCIDENT_COLUMNS.split(", "))


@query("incident_files", f"""SELECT event_id, deviation_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(start_time + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS end_time, latitude, longitude
    FROM ({_SITUATIONS}) WHERE start_time IS NOT NULL""")
def incident_files(t):
    path = scratch_path(t.spark, "situations")
    situations = feeds.parse_situations(situation_xml(t), "value")
    feeds.write_situations(situations, path)
    typed = feeds.typed_incidents(feeds.flatten_incidents(feeds.read_situations(t.spark, path), "2025-12-10"))
    return typed.select("event_id", "deviation_id", "start_time", "end_time", "latitude", "longitude")


def landed_weather(t):
    """One response per station and day (at most 24 hours each)."""
    hours = F.array_sort(F.collect_list(F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature_2m", "cloud_cover")))
    hourly = F.struct(*[F.col(f"h.{c}").alias(c) for c in ("time", "temperature_2m", "cloud_cover")])
    return t.weather.groupBy("latitude", "longitude", "date").agg(hours.alias("h")).select(
        F.to_json(F.struct("latitude", "longitude", hourly.alias("hourly"))).alias("value")
    )


@query("weather_unpivot", """SELECT strftime(((ts AT TIME ZONE 'Europe/Stockholm') AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M:%S') AS "timestamp", CAST(ts AS DATE)::VARCHAR AS date, CAST(hour(ts) AS BIGINT) AS hour,
    temperature_2m, CAST(cloud_cover AS DOUBLE) AS cloud_cover, NULL::DOUBLE AS rain, latitude FROM (SELECT *, "timestamp" AS ts FROM weather)""".replace("SELECT *, \"timestamp\" AS ts FROM weather", "SELECT \"timestamp\" AS ts, temperature_2m, cloud_cover, latitude FROM weather"))
def weather_unpivot(t):
    rows = feeds.unpivot_weather(feeds.parse_weather(landed_weather(t), "value"))
    assert set(WEATHER_MEASURES) < set(rows.columns)
    return rows.select("timestamp", "date", "hour", "temperature_2m", "cloud_cover", "rain", "latitude")


def landed_holidays(t):
    """One response per day."""

    def ja(c):
        return F.when(F.col(c), "Ja").otherwise("Nej")

    day = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("datum"), F.weekofyear("date").cast("string").alias("vecka"),
        (F.weekday("date") + 1).cast("string").alias("dag i vecka"), ja("is_work_free").alias("arbetsfri dag"),
        ja("is_red_day").alias("röd dag"), ja("is_day_before_holiday").alias("dag före arbetsfri helgdag"),
        blank_to_null(F.col("holiday_name")).alias("helgdag"),
    )
    return t.holidays.select(F.to_json(F.struct(F.array(day).alias("dagar"))).alias("value"))


@query("holiday_flatten", """SELECT CAST(date AS VARCHAR) AS date, weekofyear(date) AS week, isodow(date) AS day_of_week, is_work_free, is_red_day, is_day_before_holiday, holiday_name FROM holidays""")
def holiday_flatten(t):
    flat = feeds.flatten_holidays(feeds.parse_holidays(landed_holidays(t), "value"))
    return flat.select("date", "week", "day_of_week", "is_work_free", "is_red_day", "is_day_before_holiday", "holiday_name")
