"""Daily feature job: pings to windows to enriched, conformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from headway.operators.cleaning import conform, null_normalise
from headway.operators.enrich import attach_day_constants, join_weather
from headway.operators.spatial import incident_features
from headway.operators.windows import trip_windows, window_states, windows_of_states
from headway.sources.tables import CATALOG, TableStore


def _fields(kind, names: str) -> list[StructField]:
    return [StructField(n, kind()) for n in names.split()]


COMBINED_SCHEMA = StructType(
    _fields(StringType, "trip_id")
    + _fields(TimestampType, "window_start")
    + _fields(StringType, "vehicle_id")
    + _fields(DoubleType, "avg_speed max_speed")
    + _fields(LongType, "n_positions")
    + _fields(DoubleType, "speed_std lat_min lat_max lat_mean lon_min lon_max lon_mean bearing_min bearing_max")
    + _fields(LongType, "occupancy_mode")
    + _fields(DateType, "date")
    + _fields(LongType, "hour")
    + _fields(IntegerType, "day_of_week")
    + _fields(LongType, "has_nearby_event num_nearby_traffic_events")
    + _fields(DoubleType, "nearby_event_severity")
    + _fields(StringType, "affected_roads")
    + _fields(DoubleType, "temperature_2m")
    + _fields(LongType, "relative_humidity_2m")
    + _fields(DoubleType, "precipitation rain snowfall")
    + _fields(LongType, "cloud_cover")
    + _fields(DoubleType, "wind_speed_10m wind_gusts_10m")
    + _fields(LongType, "weather_code")
    + _fields(BooleanType, "is_work_free is_red_day is_day_before_holiday is_holiday")
)


def combined_features(windows: DataFrame, incidents: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Windows with incident, weather and holiday features in the stored schema."""
    wide = incident_features(windows, incidents)
    wide = attach_day_constants(join_weather(wide, weather), holidays)
    return conform(null_normalise(wide), COMBINED_SCHEMA)


def store_pings(store: TableStore, pings: DataFrame, run: int) -> DataFrame:
    """Add the pings of a numbered run to their windows; returns the days that have them.

    The run's states are stored beside those of other runs, and the windows of its days are put together from
    all of them, so late pings add to what is there. The same number again replaces the run's own pings.
    """
    state_spec, window_spec = CATALOG["vehicle_trip_state_fg"], CATALOG["vehicle_trip_agg_fg"]
    days = store.touched(state_spec, store.upsert(state_spec, window_states(pings).withColumn("ping_run", F.lit(run).cast("bigint")), run))
    store.upsert(window_spec, windows_of_states(store.read(state_spec, only=days)))
    return days


def run_day(
    store: TableStore, pings: DataFrame, incidents: DataFrame, weather: DataFrame, holidays: DataFrame, run: int | None = None
) -> DataFrame:
    """Store windows and combined features of the days of the pings; returns the features of those days.

    With a run number the pings add to the windows of earlier runs, without one their windows replace stored
    ones. Only the stored windows of these days are read and enriched; nothing that is stored is written again.
    """
    window_spec, combined_spec = CATALOG["vehicle_trip_agg_fg"], CATALOG["combined_features_daily"]
    days = store.touched(window_spec, store.upsert(window_spec, trip_windows(pings))) if run is None else store_pings(store, pings, run)
    combined = combined_features(store.read(window_spec, only=days), incidents, weather, holidays)
    store.upsert(combined_spec, combined)
    return store.read(combined_spec, only=days)
