"""Whole-table cleaning and schema steps."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from headway.functions.values import blank_to_null, falsy_to_default, id_to_int, nan_to_null, to_number
from headway.operators.ranks import medians

# Substitutes for missing weather measures.
WEATHER_DEFAULTS = {
    "temperature_2m": 10.0,
    "precipitation": 0.0,
    "cloud_cover": 50.0,
    "wind_speed_10m": 5.0,
    "rain": 0.0,
    "snowfall": 0.0,
}


def snake_name(name: str) -> str:
    """Stripped, lower case, blanks as underscores, always starting with a letter."""
    name = re.sub(" ", "_", name.strip().lower())
    return name if name[:1].isalpha() else "f_" + name.lstrip("_")


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns that carry the same name."""
    marked = df.toDF(*[f"{i}_" for i in range(len(df.columns))])
    seen: dict[str, str] = {}
    for i, name in enumerate(df.columns):
        seen.setdefault(name, f"{i}_")
    return marked.select([F.col(pos).alias(name) for name, pos in seen.items()])


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=columns)


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c).cast("string")) for c in columns})


def ids_to_int(df: DataFrame, columns: Iterable[str] = ("trip_id", "vehicle_id"), drop_bad: bool = False) -> DataFrame:
    """Ids as whole numbers: bad ids become 0, or their rows are dropped."""
    columns = list(columns)
    if drop_bad:
        parsed = df.withColumns({c: F.trim(F.col(c)).try_cast("bigint") for c in columns})
        return parsed.na.drop(subset=columns)
    return df.withColumns({c: id_to_int(F.col(c)) for c in columns})


def numeric_share(df: DataFrame) -> DataFrame:
    """Per text column: non-null values, values that parse as numbers, and the verdict.

    A report only; ids are never cast because of it. One pass over the table.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    aggs = []
    for i, name in enumerate(texts):
        aggs += [F.count(name).alias(f"f{i}"), F.count(to_number(F.col(name))).alias(f"p{i}")]
    row = df.agg(*aggs)
    entries = [
        F.struct(F.lit(name).alias("column"), F.col(f"f{i}").alias("filled"), F.col(f"p{i}").alias("numeric"))
        for i, name in enumerate(texts)
    ]
    return row.select(F.inline(F.array(*entries))).withColumn(
        "convertible", F.col("numeric") > F.col("filled") * 0.5
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to a fixed schema; absent columns become null, bad values null (`misfits` counts those)."""
    have = set(df.columns)
    columns = []
    for field in schema.fields:
        source = F.col(field.name) if field.name in have else F.lit(None)
        columns.append(source.try_cast(field.dataType).alias(field.name))
    return df.select(columns)


def misfits(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: for each column of the schema, how many values `conform` would turn into null."""
    have = set(df.columns)
    lost = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema.fields if f.name in have}
    return df.agg(*[F.count_if(lost[f.name]).alias(f.name) if f.name in lost else F.lit(0).cast("bigint").alias(f.name) for f in schema.fields])


def fill_weather(df: DataFrame, zero_is_missing: bool = False, defaults: dict | None = None) -> DataFrame:
    """Constants for missing weather; optionally zeros count as missing too."""
    defaults = {k: v for k, v in (defaults or WEATHER_DEFAULTS).items() if k in df.columns}
    if zero_is_missing:
        return df.withColumns({c: falsy_to_default(F.col(c), v) for c, v in defaults.items()})
    return df.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(v)) for c, v in defaults.items()})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def impute_medians(train: DataFrame, frames: list[DataFrame], columns: list[str] | None = None) -> list[DataFrame]:
    """Fill nulls of every frame with the exact medians of the training frame."""
    columns = columns or numeric_columns(train)
    fill = {c: m for c, m in medians(train, columns).items() if m is not None}
    return [
        f.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(fill[c])) for c in fill})
        for f in frames
    ]


def default_end_time(df: DataFrame, open_ended: str = "day") -> DataFrame:
    """Missing ends: one day after the start, or far future for open-ended incidents."""
    later = F.col("start_time") + F.expr("interval 1 day")
    if open_ended == "forever":
        far = F.lit("9999-12-31 00:00:00").cast("timestamp")
        later = F.when(F.col("valid_until_further_notice"), far).otherwise(later)
    return df.withColumn("end_time", F.coalesce("end_time", later))


def null_normalise(df: DataFrame, id_columns: Iterable[str] = ("trip_id",)) -> DataFrame:
    """NaN and textual missing markers become null; rows without ids are dropped."""
    fixes: dict[str, Column] = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            fixes[field.name] = F.when(~F.col(field.name).isin("nan", "None"), F.col(field.name))
        elif field.dataType.typeName() in ("double", "float"):
            fixes[field.name] = nan_to_null(F.col(field.name))
    ids = list(id_columns)
    fixes.update({c: blank_to_null(F.col(c)) for c in ids})
    return df.withColumns(fixes).na.drop(subset=ids)


def flags_to_int(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Flags as 0/1, missing flags as 0; by default every boolean column."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)])
    return df.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in columns})


def active_on_day(df: DataFrame, day_start, day_end) -> DataFrame:
    """Incidents that overlap the day; open-ended ones count as not yet over."""
    return df.filter(
        (F.col("start_time") < F.lit(day_end).cast("timestamp"))
        & (
            (F.col("end_time") > F.lit(day_start).cast("timestamp"))
            | F.coalesce(F.col("valid_until_further_notice"), F.lit(False))
        )
    )


def day_or_latest(df: DataFrame, as_of, date_column: str = "date") -> DataFrame:
    """Rows of the given day, or of the newest day when that day has none.

    The wanted day is tried first with a literal filter that prunes
    partitions; only without it is the newest day looked up, from the date
    column alone.
    """
    wanted = df.filter(F.col(date_column) == F.lit(as_of).cast("date"))
    if not wanted.isEmpty():
        return wanted
    newest = df.agg(F.max(date_column)).first()[0]
    return df.filter(F.col(date_column) == F.lit(newest))


def weather_range_end(end, as_of) -> Column:
    """End of a weather backfill, at most five days before today."""
    return F.least(F.lit(end).cast("date"), F.date_sub(F.lit(as_of).cast("date"), 5))
