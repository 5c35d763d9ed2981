"""Time and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Stockholm"
WEEKDAY_COLUMNS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def clock_seconds(text: Column) -> Column:
    """Seconds of a timetable clock HH:MM:SS (hours may pass 24); null when malformed."""
    parts = F.split(text, ":")

    def part(i: int) -> Column:
        return F.trim(F.get(parts, F.lit(i))).try_cast("int")

    return F.when(F.size(parts) == 3, part(0) * 3600 + part(1) * 60 + part(2))


def clock_text(seconds: Column) -> Column:
    """HH:MM:SS of a second count, hours not wrapped at 24."""

    def two(number: Column) -> Column:
        return F.when(number < 10, F.concat(F.lit("0"), number.cast("string"))).otherwise(number.cast("string"))

    whole = seconds.cast("int")
    return F.concat_ws(
        ":", two(F.floor(whole / 3600).cast("int")), two(F.floor(whole / 60).cast("int") % 60), two(whole % 60)
    )


def epoch_instant(seconds: Column) -> Column:
    """Instant of an epoch-second count; 0 and absent mean unknown."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def local_to_utc(naive: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant of a local wall-clock time; skipped or doubled hours do not fail."""
    return F.to_utc_timestamp(naive, zone)


def parse_day(text: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_instant(text: Column) -> Column:
    """ISO text to instant, null when unreadable."""
    return F.try_to_timestamp(text)


def with_time_parts(df, instant: str = "window_start", zone: str | None = None):
    """Add date, hour and day_of_week (Monday = 0), in UTC or a given zone."""
    at = F.col(instant) if zone is None else F.from_utc_timestamp(F.col(instant), zone)
    return df.withColumns(
        {
            "date": F.to_date(at),
            "hour": F.hour(at).cast("int"),
            "day_of_week": F.weekday(at).cast("int"),
        }
    )


def weekday_flag(day: Column, columns: list[str] | None = None) -> Column:
    """The service-calendar flag that belongs to the weekday of a date."""
    flags = F.array(*[F.col(c) for c in (columns or WEEKDAY_COLUMNS)])
    return F.element_at(flags, F.weekday(day) + 1)


def yes_flag(text: Column) -> Column:
    """The feed's "Ja" is true; anything else, also a missing value, is false."""
    return F.coalesce(text == "Ja", F.lit(False))


def zero_based_weekday(one_based: Column) -> Column:
    return one_based - 1


def default_work_free(flag: Column, day: Column, weekend: bool = True) -> Column:
    """Missing work-free flags: weekend rule, or plain false for the batch jobs."""
    fallback = F.weekday(day) >= 5 if weekend else F.lit(False)
    return F.coalesce(flag, fallback)


def default_red_day(flag: Column, day: Column, weekend: bool = True) -> Column:
    fallback = F.weekday(day) == 6 if weekend else F.lit(False)
    return F.coalesce(flag, fallback)


def within_seconds(arrival_s: Column, target_s: Column, tolerance: int = 3600) -> Column:
    """Arrival no further than the tolerance from the target; never null, no midnight wrap."""
    inside = arrival_s.between(target_s - tolerance, target_s + tolerance)
    return F.coalesce(inside, F.lit(False))
