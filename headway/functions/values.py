"""Cleaning of single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """Missing ids reach us as null, blanks or the words nan / None."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin("", "nan", "None"), trimmed)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def to_number(text: Column) -> Column:
    """Double, or null when the text is no number."""
    return nan_to_null(F.trim(text).try_cast("double"))


def id_to_int(text: Column) -> Column:
    """Whole number of a text id; blank, null and non-numeric ids become 0."""
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def falsy_to_default(value: Column, default) -> Column:
    """Both null and zero give the default."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)


def null_to_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def flag_to_int(flag: Column) -> Column:
    """0/1 of a flag, a missing flag counts as 0."""
    return F.coalesce(flag, F.lit(False)).cast("int")
