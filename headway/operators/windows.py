"""Tumbling trip windows and row-per-key selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.clock import with_time_parts
from headway.functions.values import blank_to_null


def usable_pings(pings: DataFrame) -> DataFrame:
    """Pings that name both a trip and a vehicle."""
    both = F.col("trip_id").isNotNull() & F.col("vehicle_id").isNotNull()
    # the plain null test reaches the scan, the cleaned one settles blanks
    return pings.filter(both).withColumns({c: blank_to_null(F.col(c)) for c in ("trip_id", "vehicle_id")}).filter(both)


def mode_per_key(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per key, lowest value on ties.

    Votes are counted per (key, value) first, so a key that holds a large
    share of the rows is spread over its values and pre-summed before the
    shuffle instead of building one big counter map.
    """
    votes = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_votes"))
    best = F.min_by(F.col(value), F.struct(-F.col("_votes"), F.col(value)))
    return votes.groupBy(*keys).agg(best.alias(name or value))


WINDOW_KEYS = ["trip_id", "window_start"]
STATE_KEYS = [*WINDOW_KEYS, "vehicle_id", "occupancy_status"]
# numbers whose sum and count a state carries, and extremes by the name of the window column
_SUMS = {"speed": "speed", "lat": "position_lat", "lon": "position_lon"}
_EXTREMES = {
    "max_speed": (F.max, "speed"), "lat_min": (F.min, "position_lat"), "lat_max": (F.max, "position_lat"), "lon_min": (F.min, "position_lon"),
    "lon_max": (F.max, "position_lon"), "bearing_min": (F.min, "bearing"), "bearing_max": (F.max, "bearing"),
}
_COUNTED = ["n_pings", *[f"{name}_{part}" for name in _SUMS for part in ("n", "sum")]]


def ping_sums() -> list[Column]:
    """Numbers of pings that add up: counts, sums, squares and extremes. Their state has a fixed size."""
    sums = [column for name, value in _SUMS.items() for column in (F.count(value).alias(f"{name}_n"), F.sum(value).alias(f"{name}_sum"))]
    # squares about the state's own mean: those of states add up without losing digits
    squares = (F.var_pop("speed") * F.count("speed")).alias("speed_squares")
    return [*sums, squares, *[best(value).alias(name) for name, (best, value) in _EXTREMES.items()]]


def window_states(pings: DataFrame, unit: str = "minute") -> DataFrame:
    """Partial windows: one row per trip, window, vehicle and occupancy, of numbers that add up.

    States of further pings may simply be appended: `windows_of_states` takes any number of rows per key. A
    trip that holds a large share of the pings is spread over its vehicles, and tasks pre-sum their own rows.
    """
    keyed = usable_pings(pings).withColumn("window_start", F.date_trunc(unit, F.col("timestamp")))
    return keyed.filter(F.col("window_start").isNotNull()).groupBy(*STATE_KEYS).agg(F.count("*").alias("n_pings"), *ping_sums())


def _about_mean(keys: list[str]) -> Column:
    """Squares of a state's speeds about the mean of all states of the key."""
    whole = Window.partitionBy(*keys)
    mean = F.sum("speed_sum").over(whole) / F.nullif(F.sum("speed_n").over(whole), F.lit(0))
    away = F.col("speed_sum") / F.nullif(F.col("speed_n"), F.lit(0)) - mean
    return F.col("speed_squares") + F.col("speed_n") * away * away


def merged_states(states: DataFrame) -> DataFrame:
    """One state per key out of any number of them, with the same windows."""
    extremes = [best(name).alias(name) for name, (best, _) in _EXTREMES.items()]
    near = states.withColumn("speed_squares", _about_mean(STATE_KEYS))
    return near.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in (*_COUNTED, "speed_squares")], *extremes)


def window_columns(squares: Column) -> list[Column]:
    """The columns of a window from states that carry their votes. `squares`: those of all speeds about their mean."""

    def mode(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.struct(-F.col(f"{name}_votes"), name))).alias(name)

    def mean(name: str) -> Column:
        return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))

    speeds = F.sum("speed_n")
    return [
        mode("vehicle_id"),
        mean("speed").alias("avg_speed"), F.max("max_speed").alias("max_speed"), speeds.alias("n_positions"),
        F.when(speeds > 1, F.sqrt(squares / (speeds - 1))).alias("speed_std"),
        F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), mean("lat").alias("lat_mean"),
        F.min("lon_min").alias("lon_min"), F.max("lon_max").alias("lon_max"), mean("lon").alias("lon_mean"),
        F.min("bearing_min").alias("bearing_min"), F.max("bearing_max").alias("bearing_max"),
        mode("occupancy_status").alias("occupancy_mode"),
    ]


def windows_of_states(states: DataFrame) -> DataFrame:
    """One row per (trip, window) with speed, position, bearing and occupancy features.

    The states meet once, by trip and window; the votes for vehicle and occupancy and the sums are then added
    up in place. Lowest value wins ties, nulls do not vote. A window's states are as many as its vehicles and
    occupancies, however many pings it has.
    """
    # one order serves the sums by window and by vehicle, the next one the sums by occupancy and the rows themselves
    near = states.repartition(*WINDOW_KEYS).sortWithinPartitions(*WINDOW_KEYS, "vehicle_id")
    near = near.withColumn("speed_squares", _about_mean(WINDOW_KEYS))
    for name in ("vehicle_id", "occupancy_status"):
        near = near.withColumn(f"{name}_votes", F.sum("n_pings").over(Window.partitionBy(*WINDOW_KEYS, name)))

    out = near.groupBy(*WINDOW_KEYS).agg(*window_columns(F.sum("speed_squares")))
    return with_time_parts(out, "window_start")


def trip_windows(pings: DataFrame, unit: str = "minute") -> DataFrame:
    """Trip windows of a batch of pings: one scan, two exchanges."""
    return windows_of_states(window_states(pings, unit))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in the given order.

    row_number() = 1 lets Spark drop the losers before the shuffle, so a key
    with very many rows sends one row per input partition.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def lag_features(
    df: DataFrame, target: str = "occupancy_mode", by: str = "vehicle_id", lags=(1, 2, 3), drop_incomplete: bool = True
) -> DataFrame:
    """Earlier target values of the same vehicle as columns.

    The lag is taken within vehicle hours, so a vehicle with a large share of
    the rows is spread over all its hours. The last values of each hour are
    carried into the vehicle's next active hours; that walk sees only as many
    values per hour as the longest lag.
    """
    depth = max(lags)
    order = ["window_start", "trip_id"]
    rows = df.withColumn("_hour", F.date_trunc("hour", "window_start"))

    newest = Window.partitionBy(by, "_hour").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        rows.select(by, "_hour", F.col(target).alias("_value"), F.row_number().over(newest).alias("_back"))
        .filter(F.col("_back") <= depth)
        .groupBy(by, "_hour")
        .agg(F.array_sort(F.collect_list(F.struct("_back", "_value"))).alias("_tail"))
    )
    hours = Window.partitionBy(by).orderBy("_hour")
    earlier = F.flatten(F.filter(F.array(*[F.lag("_tail", k).over(hours) for k in range(1, depth + 1)]), F.isnotnull))
    carried = tails.select(by, "_hour", F.slice(earlier, 1, depth).alias("_carried"))

    spec = Window.partitionBy(by, "_hour").orderBy(*order)
    out = rows.join(carried, [by, "_hour"], "left").withColumn("_pos", F.row_number().over(spec))
    for k in lags:
        inside = F.lag(target, k).over(spec)
        before = F.get(F.col("_carried"), F.lit(k) - F.col("_pos"))["_value"]
        out = out.withColumn(f"{target}_lag_{k}", F.when(F.col("_pos") > k, inside).otherwise(before))
    out = out.drop("_hour", "_pos", "_carried")
    return out.na.drop(subset=[f"{target}_lag_{k}" for k in lags]) if drop_incomplete else out
