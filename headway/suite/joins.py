"""Enrichment, timetable and lookup joins."""

from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import enrich, spatial
from headway.operators.cleaning import WEATHER_DEFAULTS
from headway.operators.products import stamped
from headway.plans import features
from headway.plans.model import rule_scorer
from headway.session import scratch_path
from headway.sources.tables import CATALOG, TableStore
from headway.suite.registry import query
from headway.suite.standins import haversine_sql

_TS = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
_FLAGS = "is_work_free, is_red_day, is_day_before_holiday"


@query("join_weather", f"""SELECT trip_id, {_TS}, temperature_2m, precipitation, snowfall, weather_code
    FROM windows LEFT JOIN (SELECT "timestamp" AS window_start, temperature_2m, precipitation, snowfall, weather_code FROM weather_hour) USING (window_start)""")
def join_weather(t):
    joined = enrich.join_weather(t.windows.select("trip_id", "window_start"), t.weather)
    return joined.select("trip_id", "window_start", "temperature_2m", "precipitation", "snowfall", "weather_code")


@query("join_holiday", f"SELECT trip_id, {_TS}, {_FLAGS} FROM flagged")
def join_holiday(t):
    joined = enrich.join_holidays(t.windows.select("trip_id", "window_start", "date"), t.holidays)
    return joined.drop("date")


@query("attach_day_constants", f"SELECT trip_id, {_TS}, {_FLAGS}, is_holiday FROM flagged")
def attach_day_constants(t):
    return enrich.attach_day_constants(t.windows.select("trip_id", "window_start", "date"), t.holidays).drop("date")


@query("training_set", f"""SELECT trip_id, {_TS}, CAST(occupancy_mode AS BIGINT) AS occupancy_mode, {_FLAGS}, h.temperature_2m, h.cloud_cover, round(h.rain, 7) AS rain
    FROM flagged f LEFT JOIN weather_hour h ON f.window_start = h."timestamp" """.replace("strftime(window_start", "strftime(f.window_start"))
def training_set(t):
    wide = enrich.training_set(t.windows, t.weather, t.holidays)
    return wide.select("trip_id", "window_start", "occupancy_mode", *enrich.HOLIDAY_FEATURES, "temperature_2m", "cloud_cover", "rain")


@query("feature_view", f"""SELECT w.trip_id, strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start, x.temperature_2m, round(x.rain, 7) AS rain,
    h.is_work_free, CAST(w.occupancy_mode AS BIGINT) AS occupancy_mode
    FROM windows w LEFT JOIN weather x ON w.date = x.date AND w.hour = x.hour LEFT JOIN holidays h ON w.date = h.date""")
def feature_view(t):
    view = enrich.feature_view(t.windows, t.weather, t.holidays)
    return view.select("trip_id", "window_start", "temperature_2m", "rain", "is_work_free", "occupancy_mode")


@query("join_weather_hour", f"""SELECT trip_id, {_TS}, coalesce(temperature_2m, 10) AS temperature_2m, coalesce(cloud_cover, 50) AS cloud_cover,
    coalesce(wind_speed_10m, 5) AS wind_speed_10m FROM (SELECT * FROM windows WHERE date = DATE '2024-01-17') w
    LEFT JOIN (SELECT hour, arg_min(temperature_2m, latitude) AS temperature_2m, arg_min(cloud_cover, latitude) AS cloud_cover,
        arg_min(wind_speed_10m, latitude) AS wind_speed_10m FROM weather WHERE date = DATE '2024-01-17' GROUP BY hour) x USING (hour)"""
    .replace("coalesce(wind_speed_10m, 5)", "round(coalesce(wind_speed_10m, 5), 7)"))
def join_weather_hour(t):
    day = t.windows.filter(F.col("date") == F.lit("2024-01-17").cast("date")).select("trip_id", "window_start")
    wide = enrich.join_weather(day, t.weather, ["temperature_2m", "cloud_cover", "wind_speed_10m"])
    return enrich.fill_weather(wide, defaults=WEATHER_DEFAULTS)


@query("exact_ts_join", f"""SELECT w.trip_id, {_TS}, h.is_work_free, x.temperature_2m FROM windows w
    LEFT JOIN weather x ON w.window_start = x.date::TIMESTAMP JOIN holidays h ON w.window_start = h.date::TIMESTAMP""".replace("strftime(window_start", "strftime(w.window_start"))
def exact_ts_join(t):
    joined = enrich.exact_instant_join(t.windows.select("trip_id", "window_start"), t.weather, t.holidays)
    return joined.select("trip_id", "window_start", "is_work_free", "temperature_2m")


@query("trip_dim", """SELECT trip_id, route_id, agency_id, service_id, trip_headsign, route_short_name, route_long_name, agency_name
    FROM trips LEFT JOIN routes USING (route_id) LEFT JOIN agency USING (agency_id)""")
def trip_dim(t):
    return enrich.trip_dim(t.trips, t.routes, t.agency)


@query("trip_stops_fact", """SELECT trip_id, stop_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, arrival_time, departure_time, stop_headsign, stop_name,
    round(stop_lat, 7) AS stop_lat, round(stop_lon, 7) AS stop_lon FROM stop_times LEFT JOIN stops USING (stop_id)""")
def trip_stops_fact(t):
    return enrich.trip_stops_fact(t.stop_times, t.stops)


@query("trip_stops_enriched", """SELECT trip_id, stop_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, arrival_time, stop_name, route_short_name, agency_name, '2024-01-01' AS feed_date
    FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, stop_id, stop_sequence ORDER BY arrival_time, stop_headsign) AS rn FROM stop_times)
    LEFT JOIN stops USING (stop_id) LEFT JOIN trips USING (trip_id) LEFT JOIN routes USING (route_id) LEFT JOIN agency USING (agency_id) WHERE rn = 1""")
def trip_stops_enriched(t):
    fact = enrich.trip_stops_fact(t.stop_times, t.stops)
    dim = enrich.trip_dim(t.trips, t.routes, t.agency, check=False)
    wide = enrich.trip_stops_enriched(fact, dim, "2024-01-01", ["arrival_time", "stop_headsign"])
    return wide.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "stop_name", "route_short_name", "agency_name", "feed_date")


@query("many_to_one_guard", """SELECT trip_id, CAST(stop_sequence AS BIGINT) AS stop_sequence, count(*) AS n_rows FROM stop_times GROUP BY trip_id, stop_times.stop_sequence HAVING count(*) > 1""")
def many_to_one_guard(t):
    return enrich.duplicate_keys(t.stop_times, ["trip_id", "stop_sequence"])


_REGULAR = """SELECT service_id, CAST(d AS DATE) AS date FROM (SELECT *, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM calendar)
    WHERE list_extract([monday, tuesday, wednesday, thursday, friday, saturday, sunday], isodow(d)) = 1"""


@query("weekday_flag", f"SELECT service_id, CAST(date AS VARCHAR) AS date FROM ({_REGULAR})")
def weekday_flag(t):
    return cal.regular_days(t.calendar)


@query("service_calendar", f"""SELECT service_id, CAST(date AS VARCHAR) AS date FROM (
    SELECT * FROM ({_REGULAR} UNION SELECT service_id, date FROM calendar_dates WHERE exception_type = 1)
    EXCEPT SELECT service_id, date FROM calendar_dates WHERE exception_type = 2)""")
def service_calendar(t):
    return cal.service_calendar(t.calendar, t.calendar_dates)


@query("calendar_set_ops", f"""SELECT service_id, count(*) AS n_days FROM (
    SELECT * FROM ({_REGULAR} UNION SELECT service_id, date FROM calendar_dates WHERE exception_type = 1)
    EXCEPT SELECT service_id, date FROM calendar_dates WHERE exception_type = 2) GROUP BY 1""")
def calendar_set_ops(t):
    adds = t.calendar_dates.filter(F.col("exception_type") == cal.ADDED).select("service_id", "date")
    removes = t.calendar_dates.filter(F.col("exception_type") == cal.REMOVED).select("service_id", "date")
    kept = cal.regular_days(t.calendar).union(adds).distinct().join(removes, ["service_id", "date"], "left_anti")
    return kept.groupBy("service_id").agg(F.count("*").alias("n_days"))


@query("running_trips", f"""SELECT DISTINCT trip_id FROM trips WHERE service_id IN (SELECT service_id FROM (
    SELECT * FROM ({_REGULAR} UNION SELECT service_id, date FROM calendar_dates WHERE exception_type = 1)
    EXCEPT SELECT service_id, date FROM calendar_dates WHERE exception_type = 2) WHERE date = DATE '2024-01-10')""")
def running_trips(t):
    active = cal.service_calendar(t.calendar, t.calendar_dates)
    return cal.running_trips(t.trips, active, "2024-01-10").select("trip_id").distinct()


_NEAREST = f"""
    WITH pl AS (SELECT DISTINCT stop_lat, stop_lon FROM stops JOIN stop_times USING (stop_id)),
    nr AS (SELECT request_id, r."at" AS t_at, stop_lat, stop_lon, {haversine_sql('r.lat', 'r.lon', 'p.stop_lat', 'p.stop_lon', 6371000.0)} AS d
           FROM requests r JOIN pl p ON abs(r.lat - p.stop_lat) < 0.01 AND abs(r.lon - p.stop_lon) < 0.02),
    c AS (SELECT request_id, d, trip_id, stop_sequence, stop_name, stop_headsign, arrival_s, abs(arrival_s - (hour(t_at) * 3600 + minute(t_at) * 60)) AS gap
          FROM nr JOIN stops USING (stop_lat, stop_lon) JOIN stop_times USING (stop_id) WHERE d <= 1000),
    k AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY (CASE WHEN d <= 500 THEN 0 ELSE 2 END) + (CASE WHEN gap <= 3600 THEN 0 ELSE 1 END),
          d, gap, trip_id, stop_sequence) AS rn FROM c)
    SELECT request_id, trip_id, trip_headsign, stop_name AS closest_stop, stop_headsign AS closest_stop_headsign, route_short_name, route_long_name,
    CAST(round_even(d, 0) AS BIGINT) AS distance_m FROM k LEFT JOIN trips USING (trip_id) LEFT JOIN routes USING (route_id) WHERE rn = 1"""


_TRIP = ["route_short_name", "route_long_name", "trip_headsign"]


@query("nearest_trip", _NEAREST)
def nearest_trip(t):
    fact = enrich.trip_stops_fact(t.stop_times, t.stops, check=False)
    dim = enrich.trip_dim(t.trips, t.routes, t.agency, check=False)
    # only the trips that win meet their lines; of repeated trips one is taken
    winners = spatial.nearest_trip(t.requests, fact)
    named = enrich.many_to_one(winners, dim.select("trip_id", *_TRIP), ["trip_id"], "trips", False)
    one = named.groupBy(*winners.columns).agg(F.min(F.struct(*_TRIP)).alias("_trip"))
    return one.select("request_id", "trip_id", *[f"_trip.{c}" for c in _TRIP], "closest_stop", "closest_stop_headsign", "distance_m")


@query("closest_stop", f"""SELECT request_id, stop_name, stop_headsign FROM requests LEFT JOIN (SELECT request_id, stop_name, stop_headsign FROM (SELECT request_id, stop_name, stop_headsign,
    row_number() OVER (PARTITION BY request_id ORDER BY {haversine_sql('r.lat', 'r.lon', 's.stop_lat', 's.stop_lon', 6371000.0)}, stop_sequence, stop_id, stop_name, stop_headsign) AS rn
    FROM requests r JOIN stop_times USING (trip_id) JOIN stops s USING (stop_id)) WHERE rn = 1) USING (request_id)""")
def closest_stop(t):
    return spatial.closest_stop(t.requests, t.stop_times.join(t.stops, "stop_id"))


@query("top1_nearest", f"""SELECT request_id, min(round({haversine_sql('r.lat', 'r.lon', 's.stop_lat', 's.stop_lon', 6371000.0)}, 3)) AS distance_m
    FROM requests r JOIN stops s ON abs(r.lat - s.stop_lat) < 0.06 AND abs(r.lon - s.stop_lon) < 0.11
    WHERE {haversine_sql('r.lat', 'r.lon', 's.stop_lat', 's.stop_lon', 6371000.0)} <= 5000 GROUP BY 1""")
def top1_nearest(t):
    """Distance to the closest stop of all, for requests with a stop within 5 km."""
    return spatial.nearest_place(t.requests, t.stops).withColumn("distance_m", F.round("distance_m", 3))


@query("nearest_hour_weather", """WITH tg AS (SELECT event_id, date_trunc('hour', ts) AS h FROM events),
    hs AS (SELECT DISTINCT h FROM tg),
    m AS (SELECT h, "timestamp" AS w, temperature_2m, row_number() OVER (PARTITION BY h ORDER BY abs(epoch(h) - epoch("timestamp")), "timestamp") AS rn
          FROM hs CROSS JOIN weather_hour)
    SELECT event_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS w_hour, temperature_2m FROM tg JOIN m USING (h) WHERE m.rn = 1""")
def nearest_hour_weather(t):
    targets = t.table("events").select("event_id", F.col("ts").alias("target_time"))
    return enrich.nearest_hour(targets, t.weather).select("event_id", "w_hour", "temperature_2m")


@query("hour_lookup", """SELECT event_id, coalesce(temperature_2m, 10) AS temperature_2m, coalesce(cloud_cover, 50) AS cloud_cover
    FROM events LEFT JOIN weather_hour ON date_trunc('hour', ts) = "timestamp" """)
def hour_lookup(t):
    targets = t.table("events").select("event_id", F.col("ts").alias("target_time"))
    return enrich.hour_lookup(targets, t.weather).select("event_id", "temperature_2m", "cloud_cover")


@query("forecast_lookup", """WITH f AS (SELECT trip_id, hour, weekday, predicted FROM (SELECT trip_id, hour, day_of_week AS weekday, window_start,
        CASE WHEN (hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18) THEN CASE WHEN is_work_free OR is_red_day THEN 1 WHEN hour < 8 OR hour > 17 THEN 2 ELSE 3 END
             WHEN hour BETWEEN 10 AND 15 THEN 1 ELSE 0 END AS predicted, row_number() OVER (PARTITION BY trip_id, hour, day_of_week ORDER BY window_start DESC) AS rn FROM flagged) WHERE rn = 1)
    SELECT feed_entity_id, CAST(f.predicted AS BIGINT) AS predicted_occupancy, CASE WHEN f.predicted IS NOT NULL THEN 0.6::DOUBLE END AS confidence
    FROM pings p LEFT JOIN f ON p.trip_id = f.trip_id AND hour(p."timestamp") = f.hour AND isodow(p."timestamp") - 1 = f.weekday""")
def forecast_lookup(t):
    windows = enrich.join_holidays(t.windows, t.holidays)
    forecast = stamped(rule_scorer(windows).withColumnRenamed("day_of_week", "weekday"), "2024-02-01 00:00:00")
    requests = t.pings.select(
        "feed_entity_id", "trip_id", F.hour("timestamp").alias("hour"), F.weekday("timestamp").alias("weekday")
    )
    return enrich.forecast_lookup(requests, forecast).select("feed_entity_id", "predicted_occupancy", "confidence")


_ROUNDED = ", ".join(f"round({c}, 7) AS {c}" for c in (
    "avg_speed max_speed speed_std lat_min lat_max lat_mean lon_min lon_max lon_mean bearing_min bearing_max "
    "temperature_2m precipitation rain snowfall wind_speed_10m wind_gusts_10m").split())
_WHOLE = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in "n_positions occupancy_mode hour day_of_week relative_humidity_2m cloud_cover weather_code".split())


@query("combined_features", f"""SELECT trip_id, {_TS}, vehicle_id, {_ROUNDED}, {_WHOLE}, CAST(date AS VARCHAR) AS date,
    CAST(n_events IS NOT NULL AS BIGINT) AS has_nearby_event, coalesce(n_events, 0) AS num_nearby_traffic_events, severity AS nearby_event_severity,
    roads AS affected_roads, is_work_free, is_red_day, is_day_before_holiday, is_holiday
    FROM flagged LEFT JOIN (SELECT * EXCLUDE (date, hour), "timestamp" AS window_start FROM weather_hour) USING (window_start)
    LEFT JOIN day_incident_sums USING (trip_id, window_start)""")
def combined_features(t):
    return features.combined_features(t.windows, t.day_incidents, t.weather, t.holidays)


@query("run_day_twice", """SELECT trip_id, strftime(date_trunc('minute', "timestamp"), '%Y-%m-%d %H:%M:%S') AS window_start, count(speed) AS n_positions,
    "timestamp" >= TIMESTAMP '2024-01-16' AS second_run FROM pings GROUP BY 1, 2, 4""")
def run_day_twice(t):
    """The daily job over the first half of the month and then over the second, which returns its own days only."""
    store, first = TableStore(t.spark, scratch_path(t.spark, "days")), F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    features.run_day(store, t.pings.filter(first), t.day_incidents, t.weather, t.holidays)
    second = features.run_day(store, t.pings.filter(~first), t.day_incidents, t.weather, t.holidays).select("trip_id", "window_start", F.lit(True).alias("_s"))
    every = store.read(CATALOG["combined_features_daily"]).join(second, ["trip_id", "window_start"], "left")
    return every.select("trip_id", "window_start", "n_positions", F.coalesce("_s", F.lit(False)).alias("second_run"))

