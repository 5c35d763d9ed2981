"""Static timetable files: CSV with fixed schemas, ids kept as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.clock import WEEKDAY_COLUMNS, parse_day
from headway.functions.values import to_number

SCHEMAS = {
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, stop_headsign string",
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "calendar": "service_id string, " + ", ".join(f"{d} int" for d in WEEKDAY_COLUMNS) + ", start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_desc string",
    "agency": "agency_id string, agency_name string",
    "trips": "trip_id string, route_id string, service_id string, trip_headsign string, shape_id string",
    "shapes": "shape_id string, shape_pt_sequence string, shape_pt_lat string, shape_pt_lon string, shape_dist_traveled string",
}
_DATES = {"calendar": ["start_date", "end_date"], "calendar_dates": ["date"]}


def _wanted(name: str) -> dict[str, str]:
    return {f.split()[0]: f.split()[1] for f in SCHEMAS[name].split(", ")}


def _texts(spark: SparkSession, folder: str, name: str) -> list[DataFrame]:
    """The files of one kind as text columns, one frame for each header; a column that a file lacks is null."""
    groups: dict[tuple, list[str]] = {}
    for row in spark.read.format("binaryFile").load(f"{folder}/{name}.txt").select("path").orderBy("path").collect():
        header = spark.read.option("header", True).csv(row["path"]).columns
        groups.setdefault(tuple(header), []).append(row["path"])
    parts = []
    for names, files in groups.items():
        raw = spark.read.schema(", ".join(f"`{c}` string" for c in names)).options(header=True, enforceSchema=False).csv(files)
        parts.append(raw.select([(F.col(f"`{c}`") if c in names else F.lit(None).cast("string")).alias(c) for c in _wanted(name)]))
    return parts


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One timetable file (or folder of files) of a feed.

    The header of each file decides which column is which; files of different
    agencies may order or extend their columns, so files with the same header
    are read together. The driver reads the header of every file: a feed has
    one file of a kind, or one per agency. Values that do not fit their type
    become null; `unreadable` counts them.
    """
    parts = [raw.select([F.col(c).try_cast(t).alias(c) for c, t in _wanted(name).items()]) for raw in _texts(spark, folder, name)]
    table = reduce(DataFrame.unionByName, parts)
    return table.withColumns({c: parse_day(F.col(c)) for c in _DATES.get(name, [])}) if name in _DATES else table


def unreadable(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """For each column that is not text, how many values `read_table` makes null: one row, one pass."""
    dates = _DATES.get(name, [])
    typed = {c: F.col(c).try_cast(t) for c, t in _wanted(name).items() if t != "string"} | {c: parse_day(F.col(c)) for c in dates}
    lost = [F.count_if((F.trim(c) != "") & read.isNull()).alias(c) for c, read in typed.items()]
    return reduce(DataFrame.unionByName, _texts(spark, folder, name)).agg(F.count("*").alias("n_rows"), *lost)


def read_timetable(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in SCHEMAS}


def normalise_shapes(shapes: DataFrame, sort: bool = True) -> DataFrame:
    """Typed shape points in shape order; unreadable distances become null.

    Rows are placed by shape range and sorted inside the partitions, which is
    a total order across the written files.
    """
    typed = shapes.withColumns(
        {
            "shape_pt_sequence": F.col("shape_pt_sequence").cast("int"),
            "shape_pt_lat": F.col("shape_pt_lat").cast("double"),
            "shape_pt_lon": F.col("shape_pt_lon").cast("double"),
            "shape_dist_traveled": to_number(F.col("shape_dist_traveled")),
        }
    )
    return typed.orderBy("shape_id", "shape_pt_sequence") if sort else typed
