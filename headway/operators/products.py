"""Forecast and map products: spines, grids and GeoJSON slots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.geo import cell_ring, linspace
from headway.functions.occupancy import class_color
from headway.operators.windows import first_per_key

# Map box, grid size, service hours, default vehicle and place.
REGION_BOUNDS = {"min_lat": 56.6414, "max_lat": 58.8654, "min_lon": 14.6144, "max_lon": 16.9578}
LAT_STEPS, LON_STEPS = 40, 50
ON_DEMAND_STEPS = (15, 20)
FIRST_HOUR, LAST_HOUR = 5, 23
FORECAST_DAYS = 2
VEHICLE_DEFAULTS = {"vehicle_id": 0, "max_speed": 45.0, "n_positions": 30, "bearing_min": 0.0, "bearing_max": 360.0}
DEFAULT_LAT, DEFAULT_LON = 58.41, 15.62
FILL_OPACITY = 0.35


def service_hours(days: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Every hour 5..23 of each row's date, with instant, hour and weekday (Monday = 0)."""
    hours = F.sequence(F.lit(FIRST_HOUR), F.lit(LAST_HOUR))
    spread = days.select(*keep, "date", F.explode(hours).alias("hour"))
    at = F.timestamp_seconds(F.unix_timestamp(F.col("date").cast("timestamp")) + F.col("hour") * 3600)
    return spread.select(*keep, "date", "hour", F.weekday("date").cast("int").alias("weekday"), at.alias("window_start"))


def forecast_days(as_of, spark, days: int = FORECAST_DAYS) -> DataFrame:
    """The forecast dates: today and tomorrow."""
    start = F.lit(as_of).cast("date")
    return spark.range(days).select(F.date_add(start, F.col("id").cast("int")).alias("date"))


def forecast_spine(trips: DataFrame, days: DataFrame) -> DataFrame:
    """Every distinct trip for every service hour of the forecast dates.

    The dates are read to the driver, two as a rule; each trip row then
    expands in place and is never joined for it. The distinct trips are dealt to
    a set number of tasks: their bytes are few, the rows made of them many.
    """
    keep = ["trip_id", "route_short_name", "route_long_name"]
    one = first_per_key(trips.select(*keep), ["trip_id"], [F.col(c).asc_nulls_last() for c in keep[1:]])
    # by the whole row: by the trip alone the exchange of the choice would do, and that one is coalesced by bytes
    one = one.repartition(int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keep)
    dates = [F.lit(row["date"]) for row in days.select("date").distinct().orderBy("date").collect()]
    return service_hours(one.withColumn("date", F.explode(F.array(*dates).cast("array<date>"))), keep)


def with_vehicle_defaults(df: DataFrame, lat=DEFAULT_LAT, lon=DEFAULT_LON) -> DataFrame:
    """Typical vehicle values and one place for rows that have no pings yet."""
    place = {f"lat_{s}": F.lit(lat) for s in ("min", "max", "mean")}
    place |= {f"lon_{s}": F.lit(lon) for s in ("min", "max", "mean")}
    return df.withColumns({**{k: F.lit(v) for k, v in VEHICLE_DEFAULTS.items()}, **place})


def grid_points(bounds: DataFrame, lat_steps: int = LAT_STEPS, lon_steps: int = LON_STEPS) -> DataFrame:
    """Evenly spaced points of each bounds row (min_lat, max_lat, min_lon, max_lon), corners included."""
    rows = F.explode(F.sequence(F.lit(0), F.lit(lat_steps - 1)))
    columns = F.explode(F.sequence(F.lit(0), F.lit(lon_steps - 1)))
    spread = bounds.withColumn("lat_id", rows).withColumn("lon_id", columns)
    return spread.withColumns(
        {
            "lat": linspace(F.col("lat_id"), F.col("min_lat"), F.col("max_lat"), lat_steps),
            "lon": linspace(F.col("lon_id"), F.col("min_lon"), F.col("max_lon"), lon_steps),
            "lat_step": (F.col("max_lat") - F.col("min_lat")) / (lat_steps - 1),
            "lon_step": (F.col("max_lon") - F.col("min_lon")) / (lon_steps - 1),
        }
    )


def grid_spine(slots: DataFrame, bounds: DataFrame, lat_steps: int = LAT_STEPS, lon_steps: int = LON_STEPS) -> DataFrame:
    """Every grid point of the one bounds row for every slot."""
    box = bounds.select(*REGION_BOUNDS).first()
    return grid_points(slots.withColumns({k: F.lit(box[k]) for k in REGION_BOUNDS}), lat_steps, lon_steps)


def slot_class_counts(cells: DataFrame) -> DataFrame:
    """Cells per predicted class of each (hour, weekday)."""
    return cells.groupBy("hour", "weekday", F.col("predicted_occupancy").alias("class")).agg(F.count("*").alias("n_cells"))


def slot_summary(counts: DataFrame) -> DataFrame:
    """Readable class mix per slot; class 0 and empty classes are not mentioned."""
    named = F.when(F.col("class") != 0, F.struct("class", F.format_string("c%d:%d", "class", "n_cells").alias("t")))
    texts = F.transform(F.array_sort(F.collect_list(named)), lambda x: x["t"])
    grouped = counts.groupBy("hour", "weekday").agg(F.sum("n_cells").alias("n_cells"), F.array_join(texts, ", ").alias("mix"))
    return grouped.withColumn("mix", F.coalesce(F.nullif("mix", F.lit("")), F.lit("all class 0")))


def cell_feature(fill_opacity: float = FILL_OPACITY):
    """GeoJSON feature struct of one predicted cell."""
    ring = cell_ring(F.col("lat"), F.col("lon"), F.col("lat_step"), F.col("lon_step"))
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            class_color(F.col("predicted_occupancy")).alias("color"),
            F.lit(fill_opacity).alias("fillOpacity"),
            F.col("predicted_occupancy").alias("pred_class"),
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )


def slot_geojson(cells: DataFrame) -> DataFrame:
    """One FeatureCollection text per (hour, weekday), cells in grid order.

    A slot holds one grid, so its size is set by the grid steps and not by
    the amount of data; different slots go to different tasks.
    """
    placed = F.struct("lat_id", "lon_id", cell_feature().alias("f"))
    features = F.transform(F.array_sort(F.collect_list(placed)), lambda x: x["f"])
    return cells.groupBy("hour", "weekday").agg(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), features.alias("features"))).alias("geojson")
    )


def slot_rows(geojson: DataFrame, generated_at=None) -> DataFrame:
    """Slot table rows: typed key, text, generation time."""
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at).cast("timestamp")
    return geojson.select(
        F.col("hour").cast("int").alias("hour"), F.col("weekday").cast("int").alias("weekday"),
        "geojson", stamp.alias("generated_at"),
    )


def stamped(df: DataFrame, generated_at=None) -> DataFrame:
    """Add generated_at and make the trip id text."""
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at).cast("timestamp")
    return df.withColumns({"generated_at": stamp, "trip_id": F.col("trip_id").cast("string")})


def slots_to_map(geojson: DataFrame) -> DataFrame:
    """File form: one JSON object per row keyed "hour,weekday"."""
    key = F.concat_ws(",", F.col("hour").cast("string"), F.col("weekday").cast("string"))
    return geojson.select(F.to_json(F.create_map(key, F.col("geojson"))).alias("value"))


def map_to_slots(lines: DataFrame) -> DataFrame:
    """Back from keyed JSON objects to (hour, weekday, geojson)."""
    entries = lines.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "geojson"))
    parts = F.split("k", ",")
    return entries.select(
        F.get(parts, F.lit(0)).cast("int").alias("hour"), F.get(parts, F.lit(1)).cast("int").alias("weekday"), "geojson"
    )
