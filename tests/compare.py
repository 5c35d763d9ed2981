"""Row-set comparison of a Spark result with a DuckDB result."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else round(value, 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(normal(r[n]) for n in names) for r in df.collect()), key=repr)


def rows_of_duckdb(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, sorted((tuple(normal(r[p]) for p in places) for r in cursor.fetchall()), key=repr)
