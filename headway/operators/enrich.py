"""Key joins that widen windows, trips and forecasts.

Dimension sides carry no broadcast hint: their size depends on the data, so
Catalyst decides from the scan statistics and adaptive execution again from
the real shuffle sizes, splitting skewed hours when neither side is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.clock import default_red_day, default_work_free
from headway.operators.cleaning import fill_weather
from headway.operators.windows import first_per_key
from headway.session import written

# Weather and holiday names of the feeds.
WEATHER_MEASURES = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "snowfall",
    "cloud_cover", "wind_speed_10m", "wind_gusts_10m", "weather_code",
]
WEATHER_FEATURES = ["temperature_2m", "precipitation", "cloud_cover", "wind_speed_10m", "rain", "snowfall"]
HOLIDAY_FEATURES = ["is_work_free", "is_red_day", "is_day_before_holiday"]


class NotManyToOne(ValueError):
    """The right side of a join repeats a key."""


def assert_unique(df: DataFrame, keys: list[str], what: str = "table") -> DataFrame:
    """Raise when a key occurs twice; a single aggregation that stops at the first hit."""
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise NotManyToOne(f"{what} repeats a key of {keys}")
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def many_to_one(left: DataFrame, right: DataFrame, keys: list[str], what: str = "table", check: bool = True) -> DataFrame:
    """Left join that refuses a right side with repeated keys."""
    if check:
        assert_unique(right, keys, what)
    return left.join(right, keys, "left")


def weather_per_hour(weather: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """One weather row per hour instant: lowest station coordinates win."""
    measures = [m for m in (measures or WEATHER_MEASURES) if m in weather.columns]
    hourly = weather.withColumn("_hour", F.date_trunc("hour", "timestamp"))
    order = [F.col(c).asc_nulls_last() for c in ("timestamp", "latitude", "longitude") if c in weather.columns]
    return first_per_key(hourly, ["_hour"], order).select("_hour", *measures)


def join_weather(windows: DataFrame, weather: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """Left join on the UTC hour of the window; unmatched windows get nulls."""
    per_hour = weather_per_hour(weather, measures)
    keyed = windows.withColumn("_hour", F.date_trunc("hour", "window_start"))
    return keyed.join(per_hour, "_hour", "left").drop("_hour")


def join_holidays(
    windows: DataFrame, holidays: DataFrame, columns: list[str] | None = None, weekend: bool = False
) -> DataFrame:
    """Left join on the date; repeated dates keep one row.

    Missing flags are false, or follow the weekend rule when asked to.
    """
    columns = columns or HOLIDAY_FEATURES
    order = [F.col(c).desc_nulls_last() for c in columns]
    per_day = first_per_key(holidays.select("date", *columns), ["date"], order)
    joined = windows.join(per_day, "date", "left")
    day = F.col("date")
    rules = {"is_work_free": default_work_free, "is_red_day": default_red_day}
    flags = {
        c: rules[c](F.col(c), day, weekend) if c in rules else F.coalesce(F.col(c), F.lit(False))
        for c in columns if c.startswith("is_")
    }
    return joined.withColumns(flags)


def attach_day_constants(windows: DataFrame, holidays: DataFrame) -> DataFrame:
    """Holiday flags of the window's own day, plus whether the day has a name."""
    named = holidays.withColumn("is_holiday", F.col("holiday_name").isNotNull())
    return join_holidays(windows, named, [*HOLIDAY_FEATURES, "is_holiday"])


def training_set(windows: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Windows with the weather of their hour and the holiday flags of their day."""
    return join_holidays(join_weather(windows, weather, WEATHER_FEATURES), holidays)


VIEW_VEHICLE_COLUMNS = [
    "trip_id", "vehicle_id", "avg_speed", "max_speed", "speed_std", "n_positions",
    "lat_mean", "lon_mean", "hour", "day_of_week",
]


def feature_view(windows: DataFrame, weather: DataFrame, holidays: DataFrame, label: str = "occupancy_mode") -> DataFrame:
    """Declared join of the three tables, label last, right sides taken as they are.

    Repeated (date, hour) rows multiply the windows, as a plain join does.
    """
    w = weather.select("date", F.col("hour").cast("int").alias("hour"), *WEATHER_FEATURES)
    h = holidays.select("date", *HOLIDAY_FEATURES)
    base = windows.select("window_start", "date", *VIEW_VEHICLE_COLUMNS, label)
    joined = base.join(w, ["date", "hour"], "left").join(h, ["date"], "left")
    return joined.select("window_start", *VIEW_VEHICLE_COLUMNS, *WEATHER_FEATURES, *HOLIDAY_FEATURES, label)


def exact_instant_join(windows: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Variant: join on window_start = midnight of the date, drop rows without holiday flags."""
    w = weather.select(F.col("date").cast("timestamp").alias("window_start"), *WEATHER_FEATURES)
    h = holidays.select(F.col("date").cast("timestamp").alias("window_start"), *HOLIDAY_FEATURES)
    joined = windows.join(w, "window_start", "left").join(h, "window_start", "left")
    return joined.na.drop(subset=HOLIDAY_FEATURES)


def trip_dim(trips: DataFrame, routes: DataFrame, agency: DataFrame, check: bool = True) -> DataFrame:
    """Trips with route and agency attributes."""
    with_route = many_to_one(trips, routes, ["route_id"], "routes", check)
    return many_to_one(with_route, agency, ["agency_id"], "agency", check)


def trip_stops_fact(stop_times: DataFrame, stops: DataFrame, check: bool = True) -> DataFrame:
    """Stop times with stop attributes."""
    return many_to_one(stop_times, stops, ["stop_id"], "stops", check)


def trip_stops_enriched(fact: DataFrame, dim: DataFrame, feed_date, order: list[str], check: bool = True) -> DataFrame:
    """Stops with trip attributes, one row per (trip, stop, sequence)."""
    # duplicates meet by trip, so the join finds both sides in place
    unique = first_per_key(fact.repartition("trip_id"), ["trip_id", "stop_id", "stop_sequence"], [F.col(c) for c in order])
    joined = many_to_one(unique, dim, ["trip_id"], "trips", check)
    return joined.withColumn("feed_date", F.lit(feed_date).cast("date"))


def nearest_hour(targets: DataFrame, weather: DataFrame, target: str = "target_time") -> DataFrame:
    """Each target with the weather row closest to its hour, the earlier on ties.

    Only the distinct target hours are matched, day by day: every day takes
    the last weather hour before it and the first one after it from a table
    of day edges, so no task ever sees more than one day of hours.
    """
    measures = [m for m in WEATHER_FEATURES if m in weather.columns]
    per_hour = weather_per_hour(weather, measures).withColumnRenamed("_hour", "w_hour")
    keyed = targets.withColumn("t_hour", F.date_trunc("hour", target))
    marks = (
        keyed.select(F.col("t_hour").alias("h"), F.lit(None).cast("timestamp").alias("w"))
        .unionByName(per_hour.select(F.col("w_hour").alias("h"), F.col("w_hour").alias("w")))
        .groupBy("h").agg(F.max("w").alias("w"))
        .withColumn("d", F.to_date("h"))
    )
    # day edges: one row per calendar day
    edges = marks.groupBy("d").agg(F.min("w").alias("first_w"), F.max("w").alias("last_w"))
    calendar = Window.orderBy("d")
    edges = edges.select(
        "d",
        F.last("last_w", True).over(calendar.rowsBetween(Window.unboundedPreceding, -1)).alias("before_day"),
        F.first("first_w", True).over(calendar.rowsBetween(1, Window.unboundedFollowing)).alias("after_day"),
    )
    day = Window.partitionBy("d").orderBy("h")
    near = (
        marks.join(edges, "d")
        .withColumn("prev", F.coalesce(F.last("w", True).over(day.rowsBetween(Window.unboundedPreceding, 0)), "before_day"))
        .withColumn("next", F.coalesce(F.first("w", True).over(day.rowsBetween(0, Window.unboundedFollowing)), "after_day"))
    )
    gap_prev = F.unix_timestamp("h") - F.unix_timestamp("prev")
    gap_next = F.unix_timestamp("next") - F.unix_timestamp("h")
    take_prev = F.col("next").isNull() | (gap_prev <= gap_next)
    choice = near.select(F.col("h").alias("t_hour"), F.when(take_prev, F.col("prev")).otherwise(F.col("next")).alias("w_hour"))
    # one row per distinct hour; written so that the join is planned on its real size
    by_hour = written(choice.join(per_hour, "w_hour"), "hours")
    return keyed.join(by_hour, "t_hour", "left").drop("t_hour")


def hour_lookup(targets: DataFrame, weather: DataFrame, target: str = "target_time") -> DataFrame:
    """Weather of exactly the target's hour, defaults where there is none."""
    per_hour = weather_per_hour(weather, WEATHER_FEATURES)
    keyed = targets.withColumn("_hour", F.date_trunc("hour", target))
    return fill_weather(keyed.join(per_hour, "_hour", "left").drop("_hour"))


def forecast_lookup(requests: DataFrame, forecast: DataFrame) -> DataFrame:
    """Requests with the newest forecast of their (trip, hour, weekday), if any."""
    keys = ["trip_id", "hour", "weekday"]
    newest = first_per_key(
        forecast, keys, [F.col("generated_at").desc(), F.col("window_start").desc()]
    ).select(*keys, "predicted_occupancy", "confidence")
    return requests.join(newest, keys, "left")
