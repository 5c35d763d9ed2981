"""Occupancy classes: dimension rows, texts, and prediction helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = list(range(7))

# Class, short label, long label, message, colour name, map colour.
OCCUPANCY_ROWS = [
    (0, "Empty", "Empty", "Plenty of room - pick any seat!", "green", "#22c55e"),
    (1, "Many seats", "Many seats available", "Lots of seats to choose from.", "green", "#84cc16"),
    (2, "Few seats", "Few seats available", "Some seats left - you might need to look around.", "yellow", "#eab308"),
    (3, "Standing", "Standing room only", "Expect to stand - pack your patience!", "orange", "#f97316"),
    (4, "Crowded", "Crushed standing", "Very crowded - consider waiting for the next one.", "red", "#ef4444"),
    (5, "Full", "Full", "Bus is full - you may not get on.", "red", "#ef4444"),
    (6, "Not accepting", "Not accepting passengers", "Bus is not accepting passengers.", "gray", "#6b7280"),
]

# Band limits and colours of the older intensity map.
BAND_LIMITS = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
BAND_COLORS = ["#22c55e", "#eab308", "#f97316", "#ef4444", "#7f1d1d"]

RULE_CONFIDENCE = 0.6


def occupancy_dim(spark: SparkSession) -> DataFrame:
    """The seven classes as a table; small by definition, so safe to broadcast."""
    names = ["class", "label", "long_label", "message", "color_name", "color"]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in OCCUPANCY_ROWS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def class_color(cls: Column) -> Column:
    """Map colour; unknown classes take the colour of class 0."""
    chain = F.when(cls == 0, OCCUPANCY_ROWS[0][5])
    for row in OCCUPANCY_ROWS[1:]:
        chain = chain.when(cls == row[0], row[5])
    return chain.otherwise(OCCUPANCY_ROWS[0][5])


def intensity_band(intensity: Column) -> Column:
    """Band 0..4 of an intensity in [0, 1]; 1.0 belongs to the last band."""
    band = F.width_bucket(intensity, F.lit(BAND_LIMITS[0]), F.lit(BAND_LIMITS[-1]), F.lit(5)) - 1
    return F.when(intensity.between(0.0, 1.0), F.least(band, F.lit(4))).cast("int")


def top_class(probabilities: Column) -> Column:
    """Position of the largest probability, the first one on ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def top_confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def rule_class(hour: Column, is_work_free: Column, is_red_day: Column) -> Column:
    """Deterministic time-of-day predictor used when no model is loaded."""
    free_day = F.coalesce(is_work_free, F.lit(False)) | F.coalesce(is_red_day, F.lit(False))
    rush = hour.between(7, 9) | hour.between(16, 18)
    edge_of_rush = (hour < 8) | (hour > 17)
    return (
        F.when(rush & free_day, 1)
        .when(rush & edge_of_rush, 2)
        .when(rush, 3)
        .when(hour.between(10, 15), 1)
        .otherwise(0)
        .cast("int")
    )


def ordinal_class(p_ge_1: Column, p_ge_2: Column, p_ge_3: Column) -> Column:
    """Highest threshold whose probability exceeds one half wins."""
    return F.when(p_ge_3 > 0.5, 3).when(p_ge_2 > 0.5, 2).when(p_ge_1 > 0.5, 1).otherwise(0).cast("int")


def day_type(is_red_day: Column, is_work_free: Column) -> Column:
    return F.when(is_red_day, "Holiday").when(is_work_free, "Work-free day").otherwise("Regular day")


def route_label(short_name: Column, long_name: Column) -> Column:
    """Display name of a route from whichever names are filled."""
    has_short = F.coalesce(short_name, F.lit("")) != ""
    has_long = F.coalesce(long_name, F.lit("")) != ""
    return (
        F.when(has_short & has_long, F.concat_ws(" - ", short_name, long_name))
        .when(has_short, F.concat(F.lit("Route: "), short_name))
        .when(has_long, F.concat(F.lit("Route: "), long_name))
    )


def conditions_text(temperature: Column, snowfall: Column, rain: Column, day_kind: Column, at: Column) -> Column:
    """Weather and day summary, parts joined by a bar; absent parts are left out."""
    degrees = F.concat(F.format_string("%.0f", F.rint(temperature)), F.lit("°C"))
    return F.concat_ws(
        " | ",
        F.when(temperature.isNotNull(), degrees),
        F.when(snowfall > 0, "Snow"),
        F.when(rain > 0, "Rain"),
        day_kind,
        F.date_format(at, "EEEE"),
    )
