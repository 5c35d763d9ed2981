"""Transit tables derived from the driver's tables, in Spark and as SQL.

Every stand-in covers its whole source table. The arithmetic is the same on
both sides, so results can be compared value by value.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.clock import clock_text
from headway.functions.occupancy import rule_class
from headway.operators.enrich import join_holidays
from headway.operators.metrics import weighted_metrics
from headway.operators.windows import trip_windows
from headway.session import written

# Explicit schemas: no footer pass per query, and timestamps read as instants.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "labels": "doc_id bigint, quality int, toxic int",
}

# users whose events are the pings of one trip
USERS_PER_TRIP = 30

BOX_LAT, BOX_LON, BOX_SPAN = 56.6414, 14.6144, 0.4


def _group() -> Column:
    """Number of the trip of a ping."""
    return F.floor(F.col("user_id") / USERS_PER_TRIP).cast("string")


def spread(key: str | Column, factor: int, modulus: int, low: float) -> Column:
    """Pseudo-coordinate in [low, low + span) from an integer key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.lit(low) + (k * factor % modulus) / modulus * F.lit(BOX_SPAN)


def spread_sql(key: str, factor: int, modulus: int, low: float) -> str:
    return f"({low}::DOUBLE + ({key} * {factor} % {modulus})::DOUBLE / {modulus} * {BOX_SPAN}::DOUBLE)"


class StandIns:
    """Lazy transit tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # -- pings and windows ------------------------------------------------

    @cached_property
    def pings(self) -> DataFrame:
        return self._pings(_group().alias("trip_id"))

    @cached_property
    def named_pings(self) -> DataFrame:
        """Pings whose trips have names, which are no numbers, beside the numbers of `pings`."""
        return self._pings(F.col("event_type").alias("trip_id"), _group().alias("trip_number"))

    def _pings(self, *trip: Column) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            F.col("event_id").cast("string").alias("feed_entity_id"),
            F.col("ts").alias("timestamp"),
            F.col("user_id").cast("string").alias("vehicle_id"),
            *trip,
            spread("event_id", 7919, 1000, BOX_LAT).alias("position_lat"),
            spread("event_id", 104729, 1000, BOX_LON).alias("position_lon"),
            (k * F.lit(3.6)).alias("bearing"),
            (F.nullif(k % 3, F.lit(0)) * F.col("value")).alias("speed"),
            F.nullif(k % 5, F.lit(4)).alias("occupancy_status"),
        )

    @cached_property
    def windows(self) -> DataFrame:
        """Hour windows: as many trips as groups of users, so windows grow with events; some pings in each."""
        return trip_windows(self.pings, "hour")

    @cached_property
    def weather(self) -> DataFrame:
        """Two stations that report from all events; those of every eleventh hour count for the hour before, so it has no report."""
        k = F.get_json_object("props", "$.k").cast("int")
        seconds = F.unix_timestamp(F.date_trunc("hour", "ts"))
        hour = F.timestamp_seconds(seconds - F.when(F.floor(seconds / 3600) % 11 == 0, 3600).otherwise(0))
        return (
            self.table("events")
            .groupBy(hour.alias("timestamp"), F.when(F.col("event_id") % 2 == 0, 58.0).otherwise(58.5).alias("latitude"))
            .agg(
                F.max("value").alias("temperature_2m"),
                F.count("*").cast("double").alias("relative_humidity_2m"),
                F.min("value").alias("precipitation"),
                (F.min("value") / 2).alias("rain"),
                F.greatest(F.max("value") - 100, F.lit(0.0)).alias("snowfall"),
                F.max(k).cast("double").alias("cloud_cover"),
                (F.max("value") - F.min("value")).alias("wind_speed_10m"),
                (F.max("value") * 1.5).alias("wind_gusts_10m"),
                F.min(k).cast("bigint").alias("weather_code"),
            )
            .withColumns({"longitude": F.lit(15.6), "date": F.to_date("timestamp"), "hour": F.hour("timestamp").cast("bigint")})
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """Every third date, found from all events; the others have no holiday row."""
        d, day = F.weekday("date"), F.to_date("ts")
        return (
            self.table("events").select(F.date_sub(day, F.unix_date(day) % 3).alias("date")).distinct()
            .select(
                "date", (d >= 5).alias("is_work_free"), (d == 6).alias("is_red_day"),
                (d == 4).alias("is_day_before_holiday"), F.when(d == 6, "Sunday").alias("holiday_name"),
            )
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Windows with actual and rule-predicted class."""
        w = join_holidays(self.windows.filter(F.col("occupancy_mode").isNotNull()), self.holidays)
        return w.select(
            "window_start", "trip_id", "date", F.col("occupancy_mode").alias("actual_occupancy_mode"),
            rule_class(F.col("hour"), F.col("is_work_free"), F.col("is_red_day")).alias("predicted_occupancy_mode"),
        )

    @cached_property
    def monitor(self) -> DataFrame:
        """Stored hindcast rows: per-day run metrics on every row, two model versions."""
        scored = written(self.scored, "scored")
        metrics = weighted_metrics(scored, "actual_occupancy_mode", "predicted_occupancy_mode", ["date"])
        # one row per calendar date
        return scored.join(F.broadcast(metrics.drop("n_rows")), "date").withColumn(
            "model_version", F.when(F.dayofmonth("date") <= 15, 3).otherwise(4)
        )

    # -- timetable --------------------------------------------------------

    @cached_property
    def trips(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("trip_id"), F.col("o_custkey").cast("string").alias("route_id"),
            (F.col("o_orderkey") % 10).cast("string").alias("service_id"), F.col("o_orderpriority").alias("trip_headsign"),
        )

    @cached_property
    def routes(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("route_id"), F.col("c_nationkey").cast("string").alias("agency_id"),
            F.col("c_mktsegment").alias("route_short_name"), F.col("c_name").alias("route_long_name"),
        )

    @cached_property
    def agency(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").cast("string").alias("agency_id"), F.col("n_name").alias("agency_name"))

    @cached_property
    def stop_times(self) -> DataFrame:
        second = (F.col("l_partkey") * 37 + F.col("l_suppkey") * 311) % 100000
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("trip_id"), F.col("l_partkey").cast("string").alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence"), clock_text(second).alias("arrival_time"),
            clock_text(second + 30).alias("departure_time"), F.col("l_returnflag").alias("stop_headsign"),
        )

    @cached_property
    def stops(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("stop_id"), F.col("p_name").alias("stop_name"),
            spread("p_partkey", 7919, 997, BOX_LAT).alias("stop_lat"), spread("p_partkey", 104729, 991, BOX_LON).alias("stop_lon"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 60).cast("int"))
        return self.table("supplier").select(
            F.col("s_suppkey").cast("string").alias("service_id"),
            *[
                (F.shiftright(F.col("s_suppkey") + 21, i) % 2).cast("int").alias(d)
                for i, d in enumerate(["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"])
            ],
            start.alias("start_date"), F.date_add(start, (F.col("s_nationkey") + 3)).alias("end_date"),
        )

    @cached_property
    def calendar_dates(self) -> DataFrame:
        """Twenty-five exceptions per supplier: additions, removals and an unknown type."""
        numbered = self.table("supplier").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(24))))
        return numbered.select(
            F.col("s_suppkey").cast("string").alias("service_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("s_suppkey") * 7 + F.col("n") * 5) % 90).cast("int")).alias("date"),
            ((F.col("s_suppkey") + F.col("n")) % 3 + 1).cast("int").alias("exception_type"),
        )

    # -- incidents and requests -------------------------------------------

    @cached_property
    def order_windows(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("trip_id"), F.col("o_orderdate").alias("window_start"),
            spread("o_orderkey", 7919, 1000, BOX_LAT).alias("lat_mean"), spread("o_orderkey", 104729, 1000, BOX_LON).alias("lon_mean"),
        )

    @cached_property
    def incidents(self) -> DataFrame:
        """One incident per customer; every seventh has no end and gets a day."""
        start = F.timestamp_seconds(F.lit(788918400) + F.col("c_custkey") * 37 % 2400 * 86400)
        days = F.col("c_custkey") % 90
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("event_id"), F.col("c_nationkey").cast("string").alias("deviation_id"),
            start.alias("start_time"),
            F.timestamp_seconds(F.unix_timestamp(start) + F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(days) * 86400).alias("end_time"),
            spread("c_custkey", 31, 997, BOX_LAT).alias("latitude"), spread("c_custkey", 17, 991, BOX_LON).alias("longitude"),
            (F.col("c_nationkey") % 12).cast("string").alias("severity_code"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("affected_road"),
            (F.col("c_custkey") % 7 == 0).alias("valid_until_further_notice"),
        )

    @cached_property
    def day_incidents(self) -> DataFrame:
        """The incidents again, in the month of the pings and around the middle of the box, where windows have their means."""
        key = F.col("event_id").cast("bigint")
        start = F.timestamp_seconds(F.lit(1704067200) + key * 37 % 30 * 86400)
        days = F.when(key % 7 == 0, 1).otherwise(key % 10)
        return self.incidents.withColumns({
            "start_time": start, "end_time": F.timestamp_seconds(F.unix_timestamp(start) + days * 86400),
            "latitude": F.lit(BOX_LAT + 0.18) + (key * 31 % 997) / 997 * F.lit(0.04),
            "longitude": F.lit(BOX_LON + 0.18) + (key * 17 % 991) / 991 * F.lit(0.04),
        })

    @cached_property
    def requests(self) -> DataFrame:
        """One lookup per customer: a place, a time of day and a trip."""
        return self.table("customer").select(
            F.col("c_custkey").alias("request_id"), F.col("c_custkey").cast("string").alias("trip_id"),
            spread("c_custkey", 31, 997, BOX_LAT).alias("lat"), spread("c_custkey", 17, 991, BOX_LON).alias("lon"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey") * 613 % 1440 * 60).alias("at"),
        )


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float) -> str:
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * {radius} * atan2(sqrt({a}), sqrt(1 - {a})))"


def metrics_sql(source: str, by: str | None = None) -> str:
    """Weighted metrics of (actual, predicted) rows, optionally per group column."""
    g, gj = (f"{by}, ", f"USING ({by})") if by else ("", "")
    grp = f"GROUP BY {by}" if by else ""
    join_err = f"JOIN err {gj}" if by else "CROSS JOIN err"
    return f"""
    (WITH pc AS (SELECT {g}actual, predicted, count(*) AS n FROM {source} GROUP BY {g}actual, predicted),
     sides AS (SELECT {g}actual AS class, n AS a, 0 AS p, CASE WHEN actual = predicted THEN n ELSE 0 END AS h FROM pc
               UNION ALL SELECT {g}predicted, 0, n, 0 FROM pc),
     cls AS (SELECT {g}class, sum(a) AS a, sum(p) AS p, sum(h) AS h FROM sides GROUP BY {g}class),
     rates AS (SELECT *, CASE WHEN p > 0 THEN h / p ELSE 0 END AS pr, CASE WHEN a > 0 THEN h / a ELSE 0 END AS re,
                      CASE WHEN a + p > 0 THEN 2 * h / (a + p) ELSE 0 END AS f1 FROM cls),
     err AS (SELECT {g}sum(abs(actual - predicted) * n) / sum(n) AS mae FROM pc {grp}),
     q AS (SELECT {g}CAST(sum(a) AS BIGINT) AS n_rows, sum(h) / sum(a) AS accuracy, sum(pr * a) / sum(a) AS "precision",
                  sum(re * a) / sum(a) AS recall, sum(f1 * a) / sum(a) AS f1_weighted FROM rates {grp})
     SELECT * FROM q {join_err})"""


_K = "CAST(props->>'$.k' AS INTEGER)"

CTES = {
    "pings": f"""SELECT CAST(event_id AS VARCHAR) AS feed_entity_id, ts AS "timestamp", CAST(user_id AS VARCHAR) AS vehicle_id,
        CAST(user_id // {USERS_PER_TRIP} AS VARCHAR) AS trip_id, {spread_sql('event_id', 7919, 1000, BOX_LAT)} AS position_lat,
        {spread_sql('event_id', 104729, 1000, BOX_LON)} AS position_lon, {_K} * 3.6::DOUBLE AS bearing,
        nullif({_K} % 3, 0) * value AS speed, nullif({_K} % 5, 4) AS occupancy_status FROM events""",
    "windows": """SELECT s.*, v.vehicle_id, o.occupancy_status AS occupancy_mode, CAST(s.window_start AS DATE) AS date,
        CAST(hour(s.window_start) AS INTEGER) AS hour, CAST(isodow(s.window_start) - 1 AS INTEGER) AS day_of_week
        FROM (SELECT trip_id, date_trunc('hour', "timestamp") AS window_start, avg(speed) AS avg_speed, max(speed) AS max_speed,
                count(speed) AS n_positions, stddev_samp(speed) AS speed_std, min(position_lat) AS lat_min, max(position_lat) AS lat_max,
                avg(position_lat) AS lat_mean, min(position_lon) AS lon_min, max(position_lon) AS lon_max, avg(position_lon) AS lon_mean,
                min(bearing) AS bearing_min, max(bearing) AS bearing_max FROM pings GROUP BY ALL) s
        LEFT JOIN (SELECT trip_id, window_start, vehicle_id FROM (SELECT trip_id, date_trunc('hour', "timestamp") AS window_start, vehicle_id,
                row_number() OVER (PARTITION BY trip_id, date_trunc('hour', "timestamp") ORDER BY count(*) DESC, vehicle_id) AS rn
                FROM pings GROUP BY 1, 2, 3) WHERE rn = 1) v USING (trip_id, window_start)
        LEFT JOIN (SELECT trip_id, window_start, occupancy_status FROM (SELECT trip_id, date_trunc('hour', "timestamp") AS window_start, occupancy_status,
                row_number() OVER (PARTITION BY trip_id, date_trunc('hour', "timestamp") ORDER BY count(*) DESC, occupancy_status) AS rn
                FROM pings WHERE occupancy_status IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1) o USING (trip_id, window_start)""",
    "weather": f"""SELECT reported AS "timestamp", CASE WHEN event_id % 2 = 0 THEN 58.0 ELSE 58.5 END::DOUBLE AS latitude,
        max(value) AS temperature_2m, count(*)::DOUBLE AS relative_humidity_2m, min(value) AS precipitation, min(value) / 2 AS rain,
        greatest(max(value) - 100, 0.0::DOUBLE) AS snowfall, max({_K})::DOUBLE AS cloud_cover, max(value) - min(value) AS wind_speed_10m,
        max(value) * 1.5::DOUBLE AS wind_gusts_10m, min({_K})::BIGINT AS weather_code, 15.6::DOUBLE AS longitude,
        CAST(reported AS DATE) AS date, CAST(hour(reported) AS BIGINT) AS hour
        FROM (SELECT *, date_trunc('hour', ts) - to_hours(CASE WHEN epoch(date_trunc('hour', ts))::BIGINT // 3600 % 11 = 0 THEN 1 ELSE 0 END) AS reported FROM events)
        GROUP BY 1, 2, 13, 14""",
    "weather_hour": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "timestamp" ORDER BY latitude) AS rn FROM weather) WHERE rn = 1""",
    "holidays": """SELECT date, isodow(date) >= 6 AS is_work_free, isodow(date) = 7 AS is_red_day, isodow(date) = 5 AS is_day_before_holiday,
        CASE WHEN isodow(date) = 7 THEN 'Sunday' END AS holiday_name
        FROM (SELECT DISTINCT CAST(ts AS DATE) - ((CAST(ts AS DATE) - DATE '1970-01-01') % 3)::INTEGER AS date FROM events)""",
    "flagged": """SELECT w.*, coalesce(h.is_work_free, false) AS is_work_free, coalesce(h.is_red_day, false) AS is_red_day,
        coalesce(h.is_day_before_holiday, false) AS is_day_before_holiday, h.holiday_name IS NOT NULL AS is_holiday
        FROM windows w LEFT JOIN holidays h USING (date)""",
    "scored": """SELECT window_start, trip_id, date, occupancy_mode AS actual,
        CASE WHEN (hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18) THEN CASE WHEN is_work_free OR is_red_day THEN 1 WHEN hour < 8 OR hour > 17 THEN 2 ELSE 3 END
             WHEN hour BETWEEN 10 AND 15 THEN 1 ELSE 0 END AS predicted
        FROM flagged WHERE occupancy_mode IS NOT NULL""",
    "day_quality": "SELECT * FROM " + metrics_sql("scored", "date"),
    "monitor": """SELECT s.window_start, s.trip_id, s.date, s.actual AS actual_occupancy_mode, s.predicted AS predicted_occupancy_mode,
        d.accuracy, d."precision", d.recall, d.f1_weighted, d.mae, CASE WHEN day(s.date) <= 15 THEN 3 ELSE 4 END AS model_version
        FROM scored s JOIN day_quality d USING (date)""",
    "trips": """SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
        CAST(o_orderkey % 10 AS VARCHAR) AS service_id, o_orderpriority AS trip_headsign FROM orders""",
    "routes": """SELECT CAST(c_custkey AS VARCHAR) AS route_id, CAST(c_nationkey AS VARCHAR) AS agency_id,
        c_mktsegment AS route_short_name, c_name AS route_long_name FROM customer""",
    "agency": "SELECT CAST(n_nationkey AS VARCHAR) AS agency_id, n_name AS agency_name FROM nation",
    "stop_times": """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey AS VARCHAR) AS stop_id, l_linenumber AS stop_sequence,
        printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS arrival_time,
        printf('%02d:%02d:%02d', (s + 30) // 3600, (s + 30) // 60 % 60, (s + 30) % 60) AS departure_time, l_returnflag AS stop_headsign, s AS arrival_s
        FROM (SELECT *, (l_partkey * 37 + l_suppkey * 311) % 100000 AS s FROM lineitem)""",
    "stops": f"""SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name, {spread_sql('p_partkey', 7919, 997, BOX_LAT)} AS stop_lat,
        {spread_sql('p_partkey', 104729, 991, BOX_LON)} AS stop_lon FROM part""",
    "calendar": """SELECT CAST(s_suppkey AS VARCHAR) AS service_id, """
    + ", ".join(
        f"(((s_suppkey + 21) >> {i}) % 2)::INTEGER AS {d}"
        for i, d in enumerate(["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"])
    )
    + """, DATE '2024-01-01' + (s_suppkey % 60)::INTEGER AS start_date,
        DATE '2024-01-01' + (s_suppkey % 60)::INTEGER + (s_nationkey + 3) AS end_date FROM supplier""",
    "calendar_dates": """SELECT CAST(s_suppkey AS VARCHAR) AS service_id, DATE '2024-01-01' + ((s_suppkey * 7 + n * 5) % 90)::INTEGER AS date,
        ((s_suppkey + n) % 3 + 1)::INTEGER AS exception_type FROM supplier CROSS JOIN range(25) r(n)""",
    "order_windows": f"""SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderdate AS window_start,
        {spread_sql('o_orderkey', 7919, 1000, BOX_LAT)} AS lat_mean, {spread_sql('o_orderkey', 104729, 1000, BOX_LON)} AS lon_mean FROM orders""",
    "incidents": f"""SELECT CAST(c_custkey AS VARCHAR) AS event_id, CAST(c_nationkey AS VARCHAR) AS deviation_id,
        TIMESTAMP '1995-01-01' + to_days((c_custkey * 37 % 2400)::INTEGER) AS start_time,
        TIMESTAMP '1995-01-01' + to_days((c_custkey * 37 % 2400 + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE c_custkey % 90 END)::INTEGER) AS end_time,
        {spread_sql('c_custkey', 31, 997, BOX_LAT)} AS latitude, {spread_sql('c_custkey', 17, 991, BOX_LON)} AS longitude,
        CAST(c_nationkey % 12 AS VARCHAR) AS severity_code, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS affected_road,
        c_custkey % 7 = 0 AS valid_until_further_notice FROM customer""",
    "requests": f"""SELECT c_custkey AS request_id, CAST(c_custkey AS VARCHAR) AS trip_id, {spread_sql('c_custkey', 31, 997, BOX_LAT)} AS lat,
        {spread_sql('c_custkey', 17, 991, BOX_LON)} AS lon, TIMESTAMP '2024-01-01' + to_minutes((c_custkey * 613 % 1440)::INTEGER) AS "at" FROM customer""",
    "day_incidents": f"""SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_days((k * 37 % 30)::INTEGER) AS start_time,
        TIMESTAMP '2024-01-01' + to_days((k * 37 % 30 + CASE WHEN k % 7 = 0 THEN 1 ELSE k % 10 END)::INTEGER) AS end_time,
        ({BOX_LAT + 0.18}::DOUBLE + (k * 31 % 997)::DOUBLE / 997 * 0.04::DOUBLE) AS latitude,
        ({BOX_LON + 0.18}::DOUBLE + (k * 17 % 991)::DOUBLE / 991 * 0.04::DOUBLE) AS longitude) FROM (SELECT *, CAST(event_id AS BIGINT) AS k FROM incidents)""",
    "near_day_incidents": f"""SELECT w.trip_id, w.window_start, i.* FROM windows w JOIN day_incidents i
        ON w.window_start BETWEEN i.start_time AND i.end_time AND i.start_time <= i.end_time
        WHERE {haversine_sql('w.lat_mean', 'w.lon_mean', 'i.latitude', 'i.longitude', 6371008.8)} <= 500""",
    "day_incident_sums": """SELECT trip_id, window_start, CAST(sum(n) AS BIGINT) AS n_events, max(sev)::DOUBLE AS severity,
        string_agg(affected_road, ',' ORDER BY first_start, first_event) AS roads
        FROM (SELECT trip_id, window_start, affected_road, count(*) AS n, max(TRY_CAST(severity_code AS INTEGER)) AS sev,
              min(start_time) AS first_start, arg_min(event_id, {'s': start_time, 'e': event_id}) AS first_event
              FROM near_day_incidents GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "near_incidents": f"""SELECT w.trip_id, w.window_start, i.* FROM order_windows w JOIN incidents i
        ON w.window_start BETWEEN i.start_time AND i.end_time AND i.start_time <= i.end_time
        WHERE {haversine_sql('w.lat_mean', 'w.lon_mean', 'i.latitude', 'i.longitude', 6371008.8)} <= 500""",
    "incident_sums": """SELECT trip_id, window_start, CAST(sum(n) AS BIGINT) AS n_events, max(sev)::DOUBLE AS severity,
        string_agg(affected_road, ',' ORDER BY first_start, first_event) AS roads
        FROM (SELECT trip_id, window_start, affected_road, count(*) AS n, max(TRY_CAST(severity_code AS INTEGER)) AS sev,
              min(start_time) AS first_start, arg_min(event_id, {'s': start_time, 'e': event_id}) AS first_event
              FROM near_incidents GROUP BY 1, 2, 3) GROUP BY 1, 2""",
}

CTES["named_pings"] = "SELECT * EXCLUDE (event_type) REPLACE (event_type AS trip_id), trip_id AS trip_number FROM (" + CTES["pings"].replace(" FROM events", ", event_type FROM events") + ")"


def with_ctes(body: str) -> str:
    """Prefix a statement with the stand-ins it names, each after those it builds on."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"(?:FROM|JOIN|IN)\s+\(?\s*{name}\b", text):
                need(CTES[name])
                ordered.append(name)

    need(body)
    if not ordered:
        return body.strip()
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
