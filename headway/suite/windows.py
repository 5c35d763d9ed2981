"""Windows, row selection, splits, ordering."""

from pyspark.sql import functions as F

from headway.functions.clock import with_time_parts
from headway.operators import metrics, ranks
from headway.operators.windows import first_per_key, lag_features, last_per_key, mode_per_key, trip_windows, usable_pings
from headway.plans import features
from headway.session import scratch_path
from headway.sources.tables import CATALOG, TableStore
from headway.suite.registry import query

_WINDOW_COLUMNS = """trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, vehicle_id, round(avg_speed, 7) AS avg_speed,
    round(max_speed, 7) AS max_speed, CAST(n_positions AS BIGINT) AS n_positions, round(speed_std, 7) AS speed_std,
    round(lat_min, 7) AS lat_min, round(lat_max, 7) AS lat_max, round(lat_mean, 7) AS lat_mean, round(lon_min, 7) AS lon_min,
    round(lon_max, 7) AS lon_max, round(lon_mean, 7) AS lon_mean, round(bearing_min, 7) AS bearing_min,
    round(bearing_max, 7) AS bearing_max, CAST(occupancy_mode AS BIGINT) AS occupancy_mode,
    CAST(date AS VARCHAR) AS date, CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week"""


@query("window_1min", f"""
    WITH m AS (SELECT *, date_trunc('minute', "timestamp") AS window_start FROM pings),
    st AS (SELECT trip_id, window_start, avg(speed) AS avg_speed, max(speed) AS max_speed, count(speed) AS n_positions,
        stddev_samp(speed) AS speed_std, min(position_lat) AS lat_min, max(position_lat) AS lat_max, avg(position_lat) AS lat_mean,
        min(position_lon) AS lon_min, max(position_lon) AS lon_max, avg(position_lon) AS lon_mean, min(bearing) AS bearing_min,
        max(bearing) AS bearing_max FROM m GROUP BY ALL),
    ve AS (SELECT trip_id, window_start, vehicle_id FROM (SELECT trip_id, window_start, vehicle_id,
        row_number() OVER (PARTITION BY trip_id, window_start ORDER BY count(*) DESC, vehicle_id) AS rn FROM m GROUP BY 1, 2, 3) WHERE rn = 1),
    oc AS (SELECT trip_id, window_start, occupancy_status AS occupancy_mode FROM (SELECT trip_id, window_start, occupancy_status,
        row_number() OVER (PARTITION BY trip_id, window_start ORDER BY count(*) DESC, occupancy_status) AS rn
        FROM m WHERE occupancy_status IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1),
    w AS (SELECT *, CAST(window_start AS DATE) AS date, hour(window_start) AS hour, isodow(window_start) - 1 AS day_of_week
        FROM st JOIN ve USING (trip_id, window_start) LEFT JOIN oc USING (trip_id, window_start))
    SELECT {_WINDOW_COLUMNS} FROM w""")
def window_1min(t):
    return trip_windows(t.pings, "minute")


@query("window_1h", f"SELECT {_WINDOW_COLUMNS} FROM windows")
def window_1h(t):
    return t.windows


@query("late_windows", f"""
    WITH m AS (SELECT *, date_trunc('minute', "timestamp") AS window_start FROM pings),
    st AS (SELECT trip_id, window_start, avg(speed) AS avg_speed, max(speed) AS max_speed, count(speed) AS n_positions, stddev_samp(speed) AS speed_std,
        avg(position_lat) AS lat_mean, min(bearing) AS bearing_min FROM m GROUP BY ALL),
    ve AS (SELECT trip_id, window_start, vehicle_id FROM m GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY trip_id, window_start ORDER BY count(*) DESC, vehicle_id) = 1),
    oc AS (SELECT trip_id, window_start, occupancy_status AS occupancy_mode FROM m WHERE occupancy_status IS NOT NULL GROUP BY 1, 2, 3
        QUALIFY row_number() OVER (PARTITION BY trip_id, window_start ORDER BY count(*) DESC, occupancy_status) = 1)
    SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, vehicle_id, round(avg_speed, 7) AS avg_speed, round(max_speed, 7) AS max_speed,
        CAST(n_positions AS BIGINT) AS n_positions, round(speed_std, 7) AS speed_std, round(lat_mean, 7) AS lat_mean, round(bearing_min, 7) AS bearing_min,
        CAST(occupancy_mode AS BIGINT) AS occupancy_mode
    FROM st JOIN ve USING (trip_id, window_start) LEFT JOIN oc USING (trip_id, window_start)""")
def late_windows(t):
    """A tenth of the pings comes late, in a run that is repeated: windows are those of all pings at once."""
    store, late = TableStore(t.spark, scratch_path(t.spark, "late")), F.col("feed_entity_id").cast("bigint") % 10 == 0
    for run, pings in ((1, t.pings.filter(~late)), (2, t.pings.filter(late)), (2, t.pings.filter(late))):
        features.store_pings(store, pings, run)
    return store.read(CATALOG["vehicle_trip_agg_fg"]).select(
        "trip_id", "window_start", "vehicle_id", "avg_speed", "max_speed", "n_positions", "speed_std", "lat_mean", "bearing_min", "occupancy_mode"
    )


@query("mode_agg", """SELECT vehicle_id, CAST(occupancy_status AS BIGINT) AS "mode" FROM (SELECT vehicle_id, occupancy_status,
    row_number() OVER (PARTITION BY vehicle_id ORDER BY count(*) DESC, occupancy_status) AS rn
    FROM pings WHERE occupancy_status IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""")
def mode_agg(t):
    return mode_per_key(t.pings, ["vehicle_id"], "occupancy_status", "mode")


@query("tumbling_minute", """SELECT strftime(date_trunc('minute', "timestamp"), '%Y-%m-%d %H:%M:%S') AS minute_start,
    count(*) AS n_pings FROM pings GROUP BY 1""")
def tumbling_minute(t):
    return t.pings.groupBy(F.date_trunc("minute", "timestamp").alias("minute_start")).agg(F.count("*").alias("n_pings"))


@query("time_parts", """SELECT feed_entity_id, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date, CAST(hour("timestamp") AS BIGINT) AS hour,
    CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week FROM pings""")
def time_parts(t):
    return with_time_parts(t.pings.select("feed_entity_id", "timestamp"), "timestamp").drop("timestamp")


@query("require_ids", """SELECT trip_id, count(*) AS n_pings FROM pings
    WHERE nullif(trim(trip_id), '') IS NOT NULL AND nullif(trim(vehicle_id), '') IS NOT NULL GROUP BY 1""")
def require_ids(t):
    return usable_pings(t.pings).groupBy("trip_id").agg(F.count("*").alias("n_pings"))


@query("first_per_key", """SELECT vehicle_id, feed_entity_id, trip_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id
    ORDER BY "timestamp", feed_entity_id) AS rn FROM pings) WHERE rn = 1""")
def first_row(t):
    return first_per_key(t.pings, ["vehicle_id"], [F.col("timestamp"), F.col("feed_entity_id")]).select(
        "vehicle_id", "feed_entity_id", "trip_id"
    )


@query("last_per_key", """SELECT trip_id, stop_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, departure_time FROM (SELECT *,
    row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY departure_time DESC, CAST(stop_id AS BIGINT) DESC) AS rn
    FROM stop_times) WHERE rn = 1""")
def last_row(t):
    numbered = t.stop_times.withColumn("stop_no", F.col("stop_id").cast("bigint"))
    return last_per_key(numbered, ["trip_id", "stop_sequence"], ["departure_time", "stop_no"]).select(
        "trip_id", "stop_id", "stop_sequence", "departure_time"
    )


_SPLIT = """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
    row_number() OVER (ORDER BY window_start, substr(md5(trip_id), 1, 12)) <= floor(count(*) OVER () * 0.8) AS is_train FROM {source}"""


@query("temporal_split_ratio", _SPLIT.format(source="order_windows"))
def temporal_split_ratio(t):
    return ranks.split_by_ratio(t.order_windows).select("trip_id", "window_start", "is_train")


@query("temporal_split_date", """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
    CAST(window_start AS DATE) < DATE '2024-01-24' AS is_train FROM windows""")
def temporal_split_date(t):
    return ranks.split_by_date(t.windows, "2024-01-24").select("trip_id", "window_start", "is_train")


@query("lag_features", """SELECT * FROM (SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, vehicle_id,
    CAST(occupancy_mode AS BIGINT) AS occupancy_mode,
    CAST(lag(occupancy_mode, 1) OVER w AS BIGINT) AS occupancy_mode_lag_1, CAST(lag(occupancy_mode, 2) OVER w AS BIGINT) AS occupancy_mode_lag_2,
    CAST(lag(occupancy_mode, 3) OVER w AS BIGINT) AS occupancy_mode_lag_3 FROM windows
    WINDOW w AS (PARTITION BY vehicle_id ORDER BY window_start, trip_id))
    WHERE occupancy_mode_lag_1 IS NOT NULL AND occupancy_mode_lag_2 IS NOT NULL AND occupancy_mode_lag_3 IS NOT NULL""")
def lags(t):
    return lag_features(t.windows.select("trip_id", "window_start", "vehicle_id", "occupancy_mode"))


@query("day_delta", """SELECT *, CASE WHEN delta > 0 THEN 'up' WHEN delta < 0 THEN 'down' WHEN delta = 0 THEN 'flat' END AS trend FROM (
    SELECT CAST(date AS VARCHAR) AS date, round(accuracy, 7) AS accuracy, round(accuracy - lag(accuracy) OVER (ORDER BY date), 7) AS delta FROM day_quality)""")
def day_delta(t):
    return metrics.day_delta(metrics.daily_metrics(t.monitor))


@query("sorted_output", """SELECT trip_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, stop_id FROM stop_times ORDER BY trip_id, stop_sequence, stop_id""")
def sorted_output(t):
    return t.stop_times.select("trip_id", "stop_sequence", "stop_id").orderBy("trip_id", "stop_sequence", "stop_id")


@query("latest_100", """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(actual_occupancy_mode AS BIGINT) AS actual_occupancy_mode
    FROM monitor ORDER BY monitor.window_start DESC, trip_id LIMIT 100""")
def latest_100(t):
    return metrics.latest_rows(t.monitor).select("trip_id", "window_start", "actual_occupancy_mode")


@query("latest_daily", """SELECT CAST(date AS VARCHAR) AS date, round(accuracy, 7) AS accuracy FROM day_quality
    WHERE date = (SELECT max(date) FROM day_quality)""")
def latest_daily(t):
    return metrics.latest_daily(metrics.daily_metrics(t.monitor)).select("date", "accuracy")
