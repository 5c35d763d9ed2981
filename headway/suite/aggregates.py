"""Class statistics, quality metrics and monitoring."""

from pyspark.sql import functions as F

from headway.operators import metrics, spatial
from headway.session import written
from headway.suite.registry import query
from headway.suite.standins import haversine_sql, metrics_sql

_PAIRS = "(SELECT actual, predicted, count(*) AS n FROM scored GROUP BY 1, 2)"
A, P = "actual_occupancy_mode", "predicted_occupancy_mode"


@query("class_distribution", """SELECT CAST(occupancy_mode AS BIGINT) AS occupancy_mode, count(*) AS n_rows,
    round(100.0 * count(*) / sum(count(*)) OVER (), 7)::DOUBLE AS percent FROM windows WHERE occupancy_mode IS NOT NULL GROUP BY 1""")
def class_distribution(t):
    return metrics.class_distribution(t.windows)


@query("class_weights", """SELECT CAST(occupancy_mode AS BIGINT) AS occupancy_mode, n AS n_rows, round(tot::DOUBLE / (k * n), 7) AS balanced_weight,
    round(least(tot::DOUBLE / (k * n) * CASE occupancy_mode WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 10 WHEN 3 THEN 20 ELSE 30 END, 50), 7) AS class_weight
    FROM (SELECT occupancy_mode, n, sum(n) OVER () AS tot, count(*) OVER () AS k FROM
          (SELECT occupancy_mode, count(*) AS n FROM windows WHERE occupancy_mode IS NOT NULL GROUP BY 1))""")
def class_weights(t):
    return metrics.class_weights(t.windows)


@query("row_weights", """WITH c AS (SELECT occupancy_mode, least(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n)
    * CASE occupancy_mode WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 10 WHEN 3 THEN 20 ELSE 30 END, 50) AS cw
    FROM (SELECT occupancy_mode, count(*) AS n FROM windows WHERE occupancy_mode IS NOT NULL GROUP BY 1))
    SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(cw, 7) AS class_weight FROM windows LEFT JOIN c USING (occupancy_mode)""")
def row_weights(t):
    return metrics.with_class_weight(t.windows).select("trip_id", "window_start", "class_weight")


@query("weighted_metrics", f"""SELECT n_rows, round(accuracy, 7) AS accuracy, round("precision", 7) AS "precision", round(recall, 7) AS recall,
    round(f1_weighted, 7) AS f1_weighted, round(mae, 7) AS mae FROM {metrics_sql('scored')}""")
def weighted_metrics(t):
    return metrics.weighted_metrics(t.scored, A, P)


@query("weighted_metrics_labels", f"""WITH l AS (SELECT quality AS actual, toxic AS predicted FROM labels)
    SELECT n_rows, round(accuracy, 7) AS accuracy, round("precision", 7) AS "precision", round(recall, 7) AS recall,
    round(f1_weighted, 7) AS f1_weighted, round(mae, 7) AS mae FROM {metrics_sql('l')}""")
def weighted_metrics_labels(t):
    return metrics.weighted_metrics(t.table("labels"), "quality", "toxic")


@query("confusion_matrix", "SELECT CAST(actual AS BIGINT) AS actual, "
    + ", ".join(f"count(*) FILTER (predicted = {c}) AS pred_{c}" for c in range(7)) + " FROM scored GROUP BY actual")
def confusion_matrix(t):
    return metrics.confusion_matrix(metrics.pair_counts(t.scored, A, P))


@query("per_class_report", f"""WITH pc AS (SELECT * FROM {_PAIRS}),
    k AS (SELECT class, sum(a) AS a, sum(p) AS p, sum(h) AS h FROM (SELECT actual AS class, n AS a, 0 AS p, CASE WHEN actual = predicted THEN n ELSE 0 END AS h FROM pc
          UNION ALL SELECT predicted, 0, n, 0 FROM pc) GROUP BY 1),
    r AS (SELECT class, a, CASE WHEN p > 0 THEN h / p ELSE 0 END AS pr, CASE WHEN a > 0 THEN h / a ELSE 0 END AS re, 2 * h / (a + p) AS f1 FROM k)
    SELECT CAST(class AS VARCHAR) AS class, round(pr, 7) AS "precision", round(re, 7) AS recall, round(f1, 7) AS f1, CAST(a AS BIGINT) AS support FROM r
    UNION ALL SELECT 'macro avg', round(avg(pr), 7), round(avg(re), 7), round(avg(f1), 7), CAST(sum(a) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(pr * a) / sum(a), 7), round(sum(re * a) / sum(a), 7), round(sum(f1 * a) / sum(a), 7), CAST(sum(a) AS BIGINT) FROM r""")
def per_class_report(t):
    return metrics.class_report(metrics.pair_counts(t.scored, A, P))


_DAILY = """CAST(date AS VARCHAR) AS date, round(accuracy, 7) AS accuracy, round("precision", 7) AS "precision", round(recall, 7) AS recall,
    round(f1_weighted, 7) AS f1_weighted, round(mae, 7) AS mae"""


@query("daily_metrics", f"SELECT {_DAILY}, CAST(CASE WHEN day(date) <= 15 THEN 3 ELSE 4 END AS BIGINT) AS model_version FROM day_quality")
def daily_metrics(t):
    return metrics.daily_metrics(t.monitor)


@query("hourly_comparison", """SELECT strftime(date_trunc('hour', window_start), '%Y-%m-%d %H:%M:%S') AS hour_start,
    round(avg(actual_occupancy_mode), 7) AS actual_mean, round(avg(predicted_occupancy_mode), 7) AS predicted_mean FROM monitor GROUP BY 1""")
def hourly_comparison(t):
    return metrics.hourly_comparison(t.monitor)


@query("class_panel", """SELECT c.class::BIGINT AS class, CASE c.class WHEN 0 THEN 'Empty' WHEN 1 THEN 'Many seats' WHEN 2 THEN 'Few seats'
    WHEN 3 THEN 'Standing' WHEN 4 THEN 'Crowded' WHEN 5 THEN 'Full' ELSE 'Not accepting' END AS label,
    count(*) FILTER (actual_occupancy_mode = c.class) AS actual_count, count(*) FILTER (predicted_occupancy_mode = c.class) AS pred_count,
    round(count(*) FILTER (actual_occupancy_mode = c.class AND predicted_occupancy_mode = c.class)::DOUBLE / nullif(count(*) FILTER (actual_occupancy_mode = c.class), 0), 7) AS recall,
    round(count(*) FILTER (actual_occupancy_mode = c.class AND predicted_occupancy_mode = c.class)::DOUBLE / nullif(count(*) FILTER (predicted_occupancy_mode = c.class), 0), 7) AS "precision"
    FROM range(7) c(class) CROSS JOIN monitor GROUP BY c.class""")
def class_panel(t):
    return metrics.class_panel(t.monitor)


@query("value_counts", """SELECT field, value, count(*) AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY field), 7)::DOUBLE AS percent FROM (
    SELECT 'severity_code' AS field, severity_code AS value FROM incidents UNION ALL SELECT 'affected_road', affected_road FROM incidents)
    WHERE value IS NOT NULL GROUP BY 1, 2""")
def value_counts(t):
    return metrics.value_counts(t.incidents, ["severity_code", "affected_road"])


_COLUMNS = ["avg_speed", "max_speed", "n_positions", "lat_mean", "lon_mean", "bearing_max"]


@query("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 7) AS mean, round(stddev_samp({c}), 7) AS std, round(min({c})::DOUBLE, 7) AS "min",
    round(quantile_cont({c}::DOUBLE, 0.25), 7) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 7) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 7) AS q75,
    round(max({c})::DOUBLE, 7) AS "max" FROM windows""" for c in _COLUMNS))
def describe(t):
    return metrics.describe(written(t.windows.select(*_COLUMNS), "windows"), _COLUMNS)


@query("available_dates", """SELECT CAST(date AS VARCHAR) AS date, count(*) AS n_rows FROM windows GROUP BY windows.date ORDER BY windows.date DESC LIMIT 5""")
def available_dates(t):
    return metrics.available_dates(t.windows)


@query("version_filter", """SELECT CAST(model_version AS BIGINT) AS model_version, count(*) AS n_rows FROM monitor
    WHERE model_version = (SELECT coalesce(max(model_version) FILTER (model_version = 4), max(model_version)) FROM monitor) GROUP BY 1""")
def version_filter(t):
    return metrics.version_filter(t.monitor).groupBy("model_version").agg(F.count("*").alias("n_rows"))


@query("drift_alert", """SELECT CAST(date AS VARCHAR) AS date, accuracy < 0.65 AS alert,
    CASE WHEN accuracy < 0.6 THEN 'bad' WHEN accuracy >= 0.7 THEN 'good' ELSE 'fair' END AS accuracy_band,
    CASE WHEN f1_weighted < 0.55 THEN 'bad' WHEN f1_weighted >= 0.65 THEN 'good' ELSE 'fair' END AS f1_weighted_band,
    CASE WHEN "precision" < 0.55 THEN 'bad' WHEN "precision" >= 0.7 THEN 'good' ELSE 'fair' END AS precision_band,
    CASE WHEN mae < 0.3 THEN 'good' WHEN mae >= 0.6 THEN 'bad' ELSE 'fair' END AS mae_band FROM day_quality""")
def drift_alert(t):
    alerts = metrics.drift_alert(metrics.daily_metrics(t.monitor))
    return alerts.select("date", "alert", "accuracy_band", "f1_weighted_band", "precision_band", "mae_band")


@query("match_rate", """SELECT count(*) AS total_windows, count(n_events) AS matched_windows, round(100.0 * count(n_events) / count(*), 7)::DOUBLE AS match_percent
    FROM order_windows LEFT JOIN incident_sums USING (trip_id, window_start)""")
def match_rate(t):
    return metrics.match_rate(spatial.incident_features(t.order_windows, t.incidents))


@query("stop_bounds", """SELECT round(min(stop_lat) - 0.02::DOUBLE, 7) AS min_lat, round(max(stop_lat) + 0.02::DOUBLE, 7) AS max_lat, round(min(stop_lon) - 0.02::DOUBLE, 7) AS min_lon,
    round(max(stop_lon) + 0.02::DOUBLE, 7) AS max_lon, round(min(stop_lat), 7) AS raw_min_lat, round(max(stop_lat), 7) AS raw_max_lat,
    round(min(stop_lon), 7) AS raw_min_lon, round(max(stop_lon), 7) AS raw_max_lon, round(avg(stop_lat), 7) AS centroid_lat,
    round(avg(stop_lon), 7) AS centroid_lon, count(*) AS num_stops FROM (SELECT DISTINCT stop_lat, stop_lon FROM stops JOIN stop_times USING (stop_id))""")
def stop_bounds(t):
    return spatial.stop_bounds(t.stop_times.join(t.stops, "stop_id"))


@query("incident_radius", f"""SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_id,
    round({haversine_sql('w.lat_mean', 'w.lon_mean', 'i.latitude', 'i.longitude', 6371008.8)}, 3) AS distance_m
    FROM order_windows w JOIN incidents i ON w.window_start BETWEEN i.start_time AND i.end_time
    WHERE {haversine_sql('w.lat_mean', 'w.lon_mean', 'i.latitude', 'i.longitude', 6371008.8)} <= 500""")
def incident_radius(t):
    pairs = spatial.incident_pairs(t.order_windows, t.incidents)
    return pairs.select("trip_id", "window_start", "event_id", F.round("distance_m", 3).alias("distance_m"))


@query("incident_features", """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, coalesce(n_events, 0) AS num_nearby_traffic_events,
    severity AS nearby_event_severity, roads AS affected_roads, CASE WHEN n_events > 0 THEN 1 ELSE 0 END::BIGINT AS has_nearby_event
    FROM order_windows LEFT JOIN incident_sums USING (trip_id, window_start)""")
def incident_features(t):
    return spatial.incident_features(t.order_windows, t.incidents).drop("lat_mean", "lon_mean")
