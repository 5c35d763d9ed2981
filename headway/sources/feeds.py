"""Landed feeds to flat tables.

Vehicle positions, weather and holidays land as JSON text, incidents as XML.
Each flattener works on the parsed columns, so the same code serves a file
scan and a text column. Decoding of wire formats happens before landing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.clock import LOCAL_ZONE, epoch_instant, local_to_utc, parse_instant, yes_flag
from headway.functions.geo import pick_wkt, wkt_centroid
from headway.functions.values import blank_to_null, to_number
from headway.operators.cleaning import coerce_numeric, default_end_time
from headway.operators.enrich import WEATHER_MEASURES

FEED_MESSAGE = (
    "entity array<struct<id:string, vehicle:struct<"
    "trip:struct<trip_id:string>, vehicle:struct<id:string>, "
    "position:struct<latitude:double,longitude:double,bearing:double,speed:double>, "
    "timestamp:bigint, occupancy_status:int>>>"
)

# Column names of the landed responses.
WEATHER_RESPONSE = (
    "latitude double, longitude double, hourly struct<time:array<string>,"
    + ",".join(f"{m}:array<double>" for m in WEATHER_MEASURES)
    + ">"
)
HOLIDAY_RESPONSE = (
    "dagar array<struct<datum:string, veckodag:string, vecka:string, `dag i vecka`:string, "
    "`arbetsfri dag`:string, `röd dag`:string, `dag före arbetsfri helgdag`:string, "
    "helgdag:string, flaggdag:string>>"
)
_DEVIATION_FIELDS = [
    "Id", "StartTime", "EndTime", "ValidUntilFurtherNotice", "Header", "LocationDescriptor", "RoadNumber",
    "RoadNumberNumeric", "MessageCode", "MessageType", "SeverityCode", "SeverityText",
]
SITUATION = (
    "Id string, Deleted string, Deviation array<struct<"
    + ", ".join(f"{f}:string" for f in _DEVIATION_FIELDS)
    + ", Geometry:struct<Point:struct<WGS84:string>, Line:struct<WGS84:string>, WGS84:string>>>"
)
INCIDENT_SOURCE = "trafikverket"
# situations of one landed file at most
FILE_SITUATIONS = 50_000


def read_feed_messages(spark: SparkSession, path: str) -> DataFrame:
    """Landed messages, one per line, below date=/hour= folders.

    A line that does not fit the schema keeps what could be read of it, and its text in `bad_line`;
    `bad_records` counts such lines.
    """
    lines = spark.read.text(path)
    schema = f"{FEED_MESSAGE}, date string, hour int, bad_line string"
    read = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad_line"})
    messages = lines.filter(F.trim("value") != "").withColumn("m", read)
    folder = {"date": F.date_format("date", "yyyy-MM-dd") if dict(lines.dtypes).get("date") == "date" else F.col("date").cast("string"),
              "hour": F.col("hour").cast("int")}
    own = [folder[c].alias(c) if c in lines.columns else F.col(f"m.{c}") for c in ("date", "hour")]
    return messages.select("m.entity", *own, "m.bad_line")


def bad_records(messages: DataFrame) -> DataFrame:
    """Lines and bad lines per date."""
    return messages.groupBy("date").agg(F.count("*").alias("n_lines"), F.count("bad_line").alias("n_bad"))


def flatten_positions(messages: DataFrame) -> DataFrame:
    """One row per entity that has a vehicle; timestamp 0 or absent becomes null."""
    entities = messages.select("date", "hour", F.explode("entity").alias("e")).filter("e.vehicle is not null")
    v = F.col("e.vehicle")
    return entities.select(
        F.col("e.id").alias("feed_entity_id"),
        "date", "hour",
        epoch_instant(v["timestamp"]).alias("timestamp"),
        blank_to_null(v["vehicle"]["id"]).alias("vehicle_id"),
        blank_to_null(v["trip"]["trip_id"]).alias("trip_id"),
        v["position"]["latitude"].alias("position_lat"),
        v["position"]["longitude"].alias("position_lon"),
        v["position"]["bearing"].alias("bearing"),
        v["position"]["speed"].alias("speed"),
        v["occupancy_status"].alias("occupancy_status"),
    )


def union_hours(frames: list[DataFrame]) -> DataFrame:
    """Stack hourly pulls by column name; columns a pull lacks become null."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def hour_coverage(pings: DataFrame, date_column: str = "date", hour_column: str = "hour") -> DataFrame:
    """Per date: hours that delivered data and the list of hours that did not."""
    hour = F.col(hour_column).cast("int")
    # 24 values at most per date
    per_day = pings.groupBy(date_column).agg(F.collect_set(F.when(hour.between(0, 23), hour)).alias("_hours"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(23)), F.col("_hours"))
    return per_day.select(
        date_column,
        (F.lit(24) - F.size(missing)).alias("hours_with_data"),
        F.size(missing).alias("empty_hours"),
        F.array_join(F.array_sort(missing).cast("array<string>"), ",").alias("missing_hours"),
    )


def read_situations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").schema(SITUATION).option("rowTag", "Situation").load(path)


def parse_situations(df: DataFrame, xml_column: str) -> DataFrame:
    """Situations held as XML text in a column.

    A text costs far more to parse than to read, so the few tasks that read a table deal its texts to all first.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(xml_column).repartition(parts).select(F.from_xml(xml_column, SITUATION).alias("s")).select("s.*")


def write_situations(situations: DataFrame, path: str) -> None:
    """Situations as XML files of bounded size: a reader cannot split a file, so none may grow with the table."""
    situations.write.format("xml").options(rootTag="Result", rowTag="Situation", maxRecordsPerFile=FILE_SITUATIONS).save(path)


def flatten_incidents(situations: DataFrame, ingestion_date) -> DataFrame:
    """One row per deviation; a situation without deviations keeps one row."""
    rows = situations.select(
        F.col("Id").alias("event_id"),
        F.coalesce(F.col("Deleted") == "true", F.lit(False)).alias("deleted"),
        F.explode_outer("Deviation").alias("d"),
    )
    d = F.col("d")
    wkt = F.when(d.isNotNull(), pick_wkt(d["Geometry"]))
    centre = wkt_centroid(wkt)
    return rows.select(
        "event_id",
        d["Id"].alias("deviation_id"),
        d["StartTime"].alias("start_time"),
        d["EndTime"].alias("end_time"),
        centre["lat"].alias("latitude"),
        centre["lon"].alias("longitude"),
        wkt.alias("geometry_wkt"),
        d["RoadNumber"].alias("affected_road"),
        d["RoadNumberNumeric"].alias("road_number_numeric"),
        d["LocationDescriptor"].alias("location_description"),
        d["MessageCode"].alias("message_code"),
        d["MessageType"].alias("message_type"),
        d["SeverityCode"].alias("severity_code"),
        d["SeverityText"].alias("severity_text"),
        d["Header"].alias("header"),
        F.coalesce(d["ValidUntilFurtherNotice"] == "true", F.lit(False)).alias("valid_until_further_notice"),
        "deleted",
        F.lit(INCIDENT_SOURCE).alias("source"),
        F.lit(ingestion_date).cast("date").alias("ingestion_date"),
    )


def typed_incidents(flat: DataFrame, open_ended: str = "day", drop_deleted: bool = False) -> DataFrame:
    """Typed incident table: readable starts only, default end, numeric fields."""
    typed = flat.withColumns(
        {c: parse_instant(F.col(c)) for c in ("start_time", "end_time")}
    ).filter(F.col("start_time").isNotNull())
    typed = coerce_numeric(typed, ["latitude", "longitude", "road_number_numeric"])
    typed = default_end_time(typed, open_ended)
    return typed.filter(~F.col("deleted")) if drop_deleted else typed


def parse_weather(df: DataFrame, json_column: str) -> DataFrame:
    return df.select(F.from_json(json_column, WEATHER_RESPONSE).alias("r")).select("r.*")


def unpivot_weather(responses: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Parallel hourly arrays to one row per hour.

    Date and hour are local wall-clock values, timestamp is the UTC instant.
    Responses without hours give no rows; arrays that are absent give nulls.
    """
    arrays = F.arrays_zip(
        F.col("hourly.time").alias("time"),
        *[F.coalesce(F.col(f"hourly.{m}"), F.array().cast("array<double>")).alias(m) for m in WEATHER_MEASURES],
    )
    rows = responses.filter(F.size("hourly.time") > 0).select("latitude", "longitude", F.inline(arrays))
    local = F.to_timestamp("time")
    typed = {"weather_code": F.col("weather_code").cast("bigint")}
    return rows.withColumns(
        {"timestamp": local_to_utc(local, zone), "date": F.to_date(local), "hour": F.hour(local).cast("bigint"), **typed}
    ).select("timestamp", *WEATHER_MEASURES, "latitude", "longitude", "date", "hour")


def parse_holidays(df: DataFrame, json_column: str) -> DataFrame:
    return df.select(F.from_json(json_column, HOLIDAY_RESPONSE).alias("r")).select("r.*")


def flatten_holidays(responses: DataFrame) -> DataFrame:
    """One row per day; keyed by the local date, Ja flags as booleans."""
    days = responses.select(F.inline("dagar"))

    def whole(name: str):
        return F.coalesce(to_number(F.col(name)).cast("bigint"), F.lit(0).cast("bigint"))

    return days.select(
        F.to_date("datum").alias("date"),
        F.col("veckodag").alias("weekday"),
        whole("vecka").alias("week"),
        whole("`dag i vecka`").alias("day_of_week"),
        yes_flag(F.col("`arbetsfri dag`")).alias("is_work_free"),
        yes_flag(F.col("`röd dag`")).alias("is_red_day"),
        yes_flag(F.col("`dag före arbetsfri helgdag`")).alias("is_day_before_holiday"),
        F.col("helgdag").alias("holiday_name"),
        F.col("flaggdag").alias("flag_day"),
    )
