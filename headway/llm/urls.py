"""URL filters by dated lists: every capture is judged by the entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import query, table
from headway.session import written

ALLOW = "allow"
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]+)/"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without user, port and closing dot; empty where there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", ""), F.lit(""))


def keys_of(url: Column) -> Column:
    """What a list entry may name: the host, each parent domain of two labels or more, and the host's first folder."""
    labels = F.split(host_of(url), r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(starts, lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."))
    folder = F.regexp_extract(url, _PATH, 1)
    every = F.when(folder != "", F.array_append(domains, F.concat(host_of(url), F.lit("/"), folder, F.lit("/")))).otherwise(domains)
    return F.when(host_of(url) != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of dated list entries (entry, category, day, action 'add' or 'remove').

    An entry is active from the day of an 'add' up to the day before its next change. Of several changes on
    one day, an 'add' wins. Rows with a null in any of the four columns, or another action, say nothing.
    Returns entry, category, from_day, to_day (null: still active).
    """
    known = entries.where(F.col("action").isin("add", "remove")).select("entry", "category", "day", "action").dropna()
    daily = known.groupBy("entry", "category", "day").agg(F.min("action").alias("action"))
    change = Window.partitionBy("entry", "category").orderBy("day")
    spans = daily.withColumn("to_day", F.lead("day").over(change)).where(F.col("action") == "add")
    return spans.select("entry", "category", F.col("day").alias("from_day"), "to_day")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The verdict of every row of `captures` (page_id, url, fetched date) under the list of its fetch day.

    As-of join: keys of a capture meet intervals of the same key that touch its month, and the interval must
    hold its day; so the work for a key does not grow with the length of its history. A capture is blocked
    if an entry of a category other than 'allow' is active and none of 'allow'. A null or malformed url, or a null
    day, matches nothing and is allowed. Repeated rows are judged row by row. Returns page_id, url, host,
    fetched, n_active, entries and categories (distinct, sorted, comma-joined), blocked.
    """
    rows = written(captures.select(
        F.monotonically_increasing_id().alias("row_id"), "page_id", "url", host_of(F.col("url")).alias("host"), "fetched",
        keys_of(F.col("url")).alias("keys")), "url-captures")
    last = rows.agg(F.max("fetched").alias("day")).first()["day"]
    end = F.least(F.coalesce(F.date_sub("to_day", 1), F.lit(last)), F.lit(last))
    spans = intervals(entries).where(F.col("from_day") <= F.lit(last)).withColumn("month", F.explode(F.sequence(_month(F.col("from_day")), _month(end))))
    spans = written(spans.withColumnRenamed("entry", "key"), "url-intervals")
    asked = rows.select("row_id", "fetched", _month(F.col("fetched")).alias("month"), F.explode("keys").alias("key"))
    active = asked.join(spans, ["key", "month"]).where(
        (F.col("fetched") >= F.col("from_day")) & (F.col("to_day").isNull() | (F.col("fetched") < F.col("to_day"))))
    # one row for each key and category of a capture at most
    found = active.groupBy(F.col("row_id").alias("_row")).agg(
        F.count("*").alias("n"), F.collect_set("key").alias("entries"), F.collect_set("category").alias("categories"))
    out = rows.join(found, F.col("row_id") == F.col("_row"), "left")
    categories = F.coalesce("categories", F.array().cast("array<string>"))
    return out.select(
        "row_id", "page_id", "url", "host", "fetched", F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce(F.array_join(F.array_sort("entries"), ","), F.lit("")).alias("entries"),
        F.array_join(F.array_sort(categories), ",").alias("categories"),
        ((F.size(categories) > 0) & ~F.array_contains(categories, ALLOW)).alias("blocked"))


def fetch_day(page_id: Column) -> Column:
    """Stand-in for the fetch time, which `pages` lacks: a day of 2024 that the id determines."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id * 37, F.lit(366)).cast("int"))


def derived_entries(captures: DataFrame) -> DataFrame:
    """Stand-in for dated lists: the keys of all captures, listed and delisted as digits of their MD5 say.

    Keys whose first digit is below 'a' are listed on a day of 2024, below '6' delisted later, below '3' listed
    again, each time under one category.
    """
    keys = captures.select(F.explode(keys_of(F.col("url"))).alias("entry")).distinct().withColumn("hex", F.md5(F.col("entry").cast("binary")))
    number = lambda at, width: F.conv(F.substring("hex", at, width), 16, 10).cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), number(2, 2))
    step = number(4, 2) + 1
    category = F.element_at(F.array(F.lit("malware"), F.lit("adult"), F.lit("spam"), F.lit(ALLOW)), number(6, 1) % 4 + 1)
    change = lambda below, at, action: F.when(F.substring("hex", 1, 1) < below, F.struct(at.alias("day"), F.lit(action).alias("action")))
    changes = F.array_compact(F.array(change("a", day, "add"), change("6", F.date_add(day, step), "remove"), change("3", F.date_add(day, step + 20), "add")))
    return keys.select("entry", category.alias("category"), F.explode(changes).alias("c")).select("entry", "category", "c.day", "c.action")


_SQL = r"""
WITH cap AS (
  SELECT row_number() OVER () AS rid, page_id, url, DATE '2024-01-01' + ((page_id * 37) % 366)::INT AS fetched,
         coalesce(regexp_replace(lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', ''), '') AS host,
         coalesce(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]+)/', 1), '') AS folder FROM pages),
parts AS (SELECT *, string_split(host, '.') AS labels FROM cap),
keys AS (
  SELECT DISTINCT rid, fetched, key FROM (
    SELECT rid, fetched, unnest(list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda x: array_to_string(labels[x:], '.'))) AS key FROM parts WHERE host <> ''
    UNION ALL SELECT rid, fetched, host || '/' || folder || '/' FROM parts WHERE host <> '' AND folder <> '')),
hexed AS (SELECT DISTINCT key, md5(key) AS hex FROM keys),
listed AS (
  SELECT key, left(hex, 1) AS d, DATE '2024-01-01' + ('0x' || substr(hex, 2, 2))::INT AS day, ('0x' || substr(hex, 4, 2))::INT + 1 AS step,
         ['malware', 'adult', 'spam', 'allow'][('0x' || substr(hex, 6, 1))::INT % 4 + 1] AS category FROM hexed WHERE left(hex, 1) < 'a'),
spans AS (
  SELECT key, category, day AS from_day, CASE WHEN d < '6' THEN day + step ELSE DATE '9999-01-01' END AS to_day FROM listed
  UNION ALL SELECT key, category, day + step + 20, DATE '9999-01-01' FROM listed WHERE d < '3'),
active AS (
  SELECT rid, key, category FROM keys JOIN spans USING (key) WHERE fetched >= from_day AND fetched < to_day),
found AS (
  SELECT rid, count(*) AS n, array_to_string(list_sort(list(DISTINCT key)), ',') AS entries, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
         NOT bool_or(category = 'allow') AS blocked FROM active GROUP BY rid)
SELECT page_id, url, host, strftime(fetched, '%Y-%m-%d') AS fetched, coalesce(n, 0)::BIGINT AS n_active, coalesce(entries, '') AS entries,
       coalesce(categories, '') AS categories, coalesce(blocked, false) AS blocked
FROM cap LEFT JOIN found USING (rid)
"""


@query("op5_url_filter", _SQL)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = table(spark, sf_dir, "pages").select("page_id", "url", fetch_day(F.col("page_id")).alias("fetched"))
    out = judged(captures, derived_entries(captures)).drop("row_id")
    return out.withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd"))
