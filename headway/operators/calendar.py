"""Which service runs on which date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.clock import weekday_flag

ADDED, REMOVED = 1, 2


def regular_days(calendar: DataFrame) -> DataFrame:
    """Every date between start and end on which the weekday flag is set."""
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    span = calendar.filter(F.col("start_date") <= F.col("end_date")).withColumn("date", F.explode(days))
    return span.filter(weekday_flag(F.col("date")) == 1).select("service_id", "date")


def service_calendar(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Active (service, date) pairs: regular days plus additions minus removals.

    One aggregation instead of union, distinct and anti join: a pair stays
    when something put it there and nothing removed it.
    """
    votes = regular_days(calendar).withColumn("_removed", F.lit(0)).unionByName(
        exceptions.filter(F.col("exception_type").isin(ADDED, REMOVED)).select(
            "service_id", "date", F.when(F.col("exception_type") == REMOVED, 1).otherwise(0).alias("_removed")
        )
    )
    return (
        votes.groupBy("service_id", "date").agg(F.max("_removed").alias("_removed"))
        .filter("_removed = 0").drop("_removed")
    )


def running_trips(trip_stops: DataFrame, active: DataFrame, day) -> DataFrame:
    """Trips whose service runs on the day."""
    today = active.filter(F.col("date") == F.lit(day).cast("date")).select("service_id")
    return trip_stops.join(today, "service_id", "left_semi")
