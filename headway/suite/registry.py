"""Query registration and result formatting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import prepare
from headway.suite.standins import StandIns, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 7


def query(name: str, oracle: str | None = None):
    """Register a function of the stand-in tables; `oracle` may use stand-in names as tables."""

    def register(fn: Callable[[StandIns], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(StandIns(prepare(spark), sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_ctes(oracle)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types every engine agrees on: text for instants and dates, bigint, rounded doubles."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("double", "float"):
            c = F.round(c, DIGITS)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind in ("array", "struct", "map"):
            c = F.to_json(c)
        columns.append(c.alias(field.name))
    return df.select(columns)
