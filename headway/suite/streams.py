"""Streaming variants, run over everything that has landed."""

from pyspark.sql import functions as F

from headway.session import scratch_path
from headway.sources.tables import CATALOG, TableStore
from headway.streaming import incidents as si
from headway.streaming import windows as sw
from headway.suite.registry import query
from headway.suite.standins import SCHEMAS, StandIns

_CLOSED = """FROM windows WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""
_TS = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"


class _StreamIns(StandIns):
    """The same ping view over a file stream."""

    def table(self, name: str):
        # a pattern, as a stream takes a plain path for a folder; this one fits a file and a folder of that name
        return sw.read_stream(self.spark, f"{self.sf_dir}/{name}.parque[t]", SCHEMAS[name])


def hour_windows(t):
    return sw.stream_windows(_StreamIns(t.spark, t.sf_dir).pings, "1 hour")


def _drained(t, stream):
    path = scratch_path(t.spark, "stream")
    sw.drain_to_files(stream, path, scratch_path(t.spark, "stream-state"))
    return t.spark.read.schema(stream.schema).parquet(path)


@query("stream_window_1h", f"""SELECT trip_id, {_TS}, vehicle_id, round(avg_speed, 7) AS avg_speed, CAST(n_positions AS BIGINT) AS n_positions, round(lat_mean, 7) AS lat_mean,
    CAST(occupancy_mode AS BIGINT) AS occupancy_mode, CAST(day_of_week AS BIGINT) AS day_of_week {_CLOSED}""")
def stream_window_1h(t):
    rows = _drained(t, hour_windows(t))
    return rows.select("trip_id", "window_start", "vehicle_id", "avg_speed", "n_positions", "lat_mean", "occupancy_mode", "day_of_week")


@query("stream_window_1min", """SELECT trip_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n_positions, round(max_speed, 7) AS max_speed, round(lat_min, 7) AS lat_min
    FROM (SELECT trip_id, date_trunc('minute', "timestamp") AS w, count(speed) AS n_positions, max(speed) AS max_speed, min(position_lat) AS lat_min FROM pings GROUP BY 1, 2)
    WHERE w + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_window_1min(t):
    rows = _drained(t, sw.stream_windows(_StreamIns(t.spark, t.sf_dir).pings))
    return rows.select("trip_id", "window_start", "n_positions", "max_speed", "lat_min")


@query("stream_enrich", f"""SELECT trip_id, {_TS}, temperature_2m, is_work_free FROM (SELECT f.trip_id, f.window_start, h.temperature_2m, f.is_work_free FROM flagged f LEFT JOIN weather_hour h ON f.window_start = h."timestamp")
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_enrich(t):
    rows = _drained(t, sw.stream_enrich(hour_windows(t), t.weather, t.holidays))
    return rows.select("trip_id", "window_start", "temperature_2m", "is_work_free")


@query("stream_upsert", f"SELECT trip_id, {_TS}, CAST(n_positions AS BIGINT) AS n_positions {_CLOSED}")
def stream_upsert(t):
    store, spec = TableStore(t.spark, scratch_path(t.spark, "tables")), CATALOG["vehicle_trip_agg_fg"]
    sw.start_upserts(hour_windows(t), store, spec, scratch_path(t.spark, "stream-state")).awaitTermination()
    return store.read(spec).select("trip_id", "window_start", "n_positions")


@query("stream_incidents", """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, coalesce(n_events, 0) AS num_nearby_traffic_events,
    severity AS nearby_event_severity, roads AS affected_roads, CASE WHEN n_events > 0 THEN 1 ELSE 0 END::BIGINT AS has_nearby_event
    FROM order_windows LEFT JOIN incident_sums USING (trip_id, window_start)
    WHERE window_start < least((SELECT max(o_orderdate) FROM orders), (SELECT max(start_time) FROM incidents)) - INTERVAL 10 MINUTE""")
def stream_incidents(t):
    """Two streams, joined; of the stored matches, those of windows that the watermark has passed."""
    streams = _StreamIns(t.spark, t.sf_dir)
    pairs = _drained(t, si.stream_incident_pairs(streams.order_windows, streams.incidents))
    ends = [t.order_windows.agg(F.max("window_start")).first()[0], t.incidents.agg(F.max("start_time")).first()[0]]
    edge = F.lit(min((e for e in ends if e is not None), default=None)).cast("timestamp") - F.expr(f"INTERVAL {si.LATENESS}")
    return si.features_of_pairs(pairs.filter(F.col("window_start") < edge))
