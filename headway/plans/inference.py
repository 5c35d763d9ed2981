"""Forecast, hindcast and map jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.cleaning import day_or_latest, fill_weather, flags_to_int, ids_to_int
from headway.operators.enrich import HOLIDAY_FEATURES, hour_lookup, join_holidays, nearest_hour, training_set
from headway.operators.metrics import CURRENT_MODEL_VERSION, weighted_metrics
from headway.operators.products import (
    forecast_days, forecast_spine, grid_spine, service_hours, slot_geojson, slot_rows, stamped, with_vehicle_defaults,
)
from headway.plans.model import TARGET, Scorer, ordered_features, rule_scorer
from headway.session import written


def slot_conditions(days: DataFrame, weather: DataFrame, holidays: DataFrame, for_map: bool = False) -> DataFrame:
    """Service hours of the days with weather and holiday flags.

    Trip forecasts take the nearest weather and read a missing holiday row as
    an ordinary day. The map takes the weather of exactly that hour, defaults
    where there is none, and reads a missing holiday row by the weekend rule.
    """
    hours = service_hours(days)
    if for_map:
        return join_holidays(hour_lookup(hours, weather, "window_start"), holidays, weekend=True)
    return join_holidays(fill_weather(nearest_hour(hours, weather, "window_start").drop("w_hour")), holidays)


def trip_forecast(
    trips: DataFrame, weather: DataFrame, holidays: DataFrame, as_of, scorer: Scorer = rule_scorer,
    stop_centres: DataFrame | None = None, generated_at=None,
) -> DataFrame:
    """Occupancy of every trip for each service hour of today and tomorrow.

    Conditions are worked out once per slot and joined to the trip spine. Trips
    sit at the default place unless their stop centres (trip_id, lat, lon) are given.
    """
    days = forecast_days(as_of, trips.sparkSession)
    conditions = slot_conditions(days, weather, holidays).drop("date", "hour", "weekday")
    spine = forecast_spine(trips, days)
    # 19 hours x 2 days of conditions whatever the data size
    wide = spine.join(F.broadcast(conditions), "window_start", "left")
    wide = with_vehicle_defaults(wide).withColumnRenamed("weekday", "day_of_week")
    if stop_centres is not None:
        wide = wide.join(stop_centres, "trip_id", "left")
        wide = wide.withColumns(
            {f"{axis}_{s}": F.coalesce(axis, f"{axis}_{s}") for axis in ("lat", "lon") for s in ("min", "max", "mean")}
        ).drop("lat", "lon")
    numeric = wide.withColumnRenamed("trip_id", "trip_key").withColumn("trip_id", F.col("trip_key"))
    scored = scorer(flags_to_int(ids_to_int(_text_ids(numeric)), HOLIDAY_FEATURES))
    return stamped(
        scored.select(
            "window_start", F.col("trip_key").alias("trip_id"), "hour", F.col("day_of_week").alias("weekday"),
            "predicted_occupancy", "confidence", "route_short_name", "route_long_name",
        ),
        generated_at,
    )


def _text_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ("trip_id", "vehicle_id")})


def hindcast(
    windows: DataFrame, weather: DataFrame, holidays: DataFrame, as_of, scorer: Scorer = rule_scorer,
    model_version: int = CURRENT_MODEL_VERSION, generated_at=None,
) -> DataFrame:
    """Predictions against actuals of the day (or the newest day), with the run's metrics on each row."""
    day = day_or_latest(windows, as_of).filter(F.col(TARGET).isNotNull())
    wide = fill_weather(training_set(day, weather, holidays))
    wide = flags_to_int(wide, HOLIDAY_FEATURES).withColumn("trip_key", F.col("trip_id"))
    ready = ordered_features(ids_to_int(_text_ids(wide)), ["window_start", "trip_key", TARGET])
    scored = scorer(ready).select(
        "window_start", F.col("trip_key").alias("trip_id"),
        F.col(TARGET).cast("int").alias("actual_occupancy_mode"),
        F.col("predicted_occupancy").alias("predicted_occupancy_mode"),
    )
    # scored once, read for the metrics and for the result
    scored = written(scored, "hindcast")
    metrics = weighted_metrics(scored, "actual_occupancy_mode", "predicted_occupancy_mode").drop("n_rows").first()
    run = {name: F.lit(value).cast("double") for name, value in metrics.asDict().items()}
    return stamped(scored.withColumns({**run, "model_version": F.lit(model_version)}), generated_at)


def grid_forecast(
    days: DataFrame, bounds: DataFrame, weather: DataFrame, holidays: DataFrame, scorer: Scorer = rule_scorer, **steps
) -> DataFrame:
    """Predicted cells of all slots in one plan; each slot uses its own date's conditions."""
    cells = grid_spine(slot_conditions(days, weather, holidays, for_map=True), bounds, **steps)
    wide = with_vehicle_defaults(cells, F.col("lat"), F.col("lon"))
    wide = flags_to_int(wide.withColumns({"trip_id": F.lit(0), "day_of_week": F.col("weekday")}), HOLIDAY_FEATURES)
    return scorer(wide)


def heatmap(
    days: DataFrame, bounds: DataFrame, weather: DataFrame, holidays: DataFrame, scorer: Scorer = rule_scorer,
    generated_at=None, **steps,
) -> DataFrame:
    """Slot table: one FeatureCollection per (hour, weekday)."""
    return slot_rows(slot_geojson(grid_forecast(days, bounds, weather, holidays, scorer, **steps)), generated_at)
