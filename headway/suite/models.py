"""Model steps on the hour windows. Learned results have no SQL equivalent."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from headway.operators.cleaning import flags_to_int, ids_to_int
from headway.operators.enrich import training_set
from headway.operators.metrics import weighted_metrics
from headway.plans import inference, model
from headway.plans.boosting import Booster
from headway.session import scratch_path
from headway.suite.products import _RULE, last_days, stop_box, today
from headway.suite.registry import query

# where this process has stored the model of a session's tables
_STORED: dict[tuple[str, str], str] = {}


def labelled(t):
    return training_set(t.windows, t.weather, t.holidays)


def split(t):
    """Train and test rows; a query that trains and tests prepares them once."""
    if "split" not in vars(t):
        vars(t)["split"] = model.prepare(labelled(t))
    return vars(t)["split"]


def trained(t) -> Booster:
    """The model of the tables: fitted and stored by the first query that needs it, loaded by the others."""
    key = t.spark.sparkContext.applicationId, t.sf_dir
    if key not in _STORED:
        path = scratch_path(t.spark, "occupancy-model")
        model.train(split(t)[0]).save(t.spark, path)
        _STORED[key] = path
    return Booster.load(t.spark, _STORED[key])


_IDS, _FLAGS = ("trip_id", "vehicle_id"), ("is_work_free", "is_red_day", "is_day_before_holiday")
_WHOLE = ("n_positions", "hour", "day_of_week")
_JOINED = """flagged LEFT JOIN (SELECT * EXCLUDE (date, hour), "timestamp" AS window_start FROM weather_hour) USING (window_start)"""


def _feature_sql(name: str) -> str:
    if name in _IDS or name in _FLAGS:
        return name
    return f"CAST({name} AS BIGINT) AS {name}" if name in _WHOLE else f"round({name}, 7) AS {name}"


def _number_sql(name: str) -> str:
    """The value that the feature vector holds: ids that are no numbers and missing flags are 0."""
    if name in _IDS:
        return f"coalesce(TRY_CAST({name} AS BIGINT), 0)::DOUBLE AS {name}"
    return f"coalesce({name}, false)::INTEGER::DOUBLE AS {name}" if name in _FLAGS else f"round({name}::DOUBLE, 7) AS {name}"


@query("prepare_data", """SELECT is_train, count(*) AS n_rows, count(*) FILTER (occupancy_mode IS NULL) AS n_unlabelled, CAST(sum(occupancy_mode) AS BIGINT) AS label_sum,
    strftime(min(window_start), '%Y-%m-%d %H:%M:%S') AS first_window, strftime(max(window_start), '%Y-%m-%d %H:%M:%S') AS last_window, 0 AS n_missing, sum(is_work_free::INTEGER) AS n_work_free
    FROM (SELECT *, row_number() OVER (ORDER BY window_start, substr(md5(trip_id), 1, 12)) <= floor(count(*) OVER () * 0.8) AS is_train
    FROM flagged WHERE occupancy_mode IS NOT NULL) GROUP BY 1""")
def prepare_data(t):
    train, test = split(t)
    rows = train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
    return rows.groupBy("is_train").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("occupancy_mode").isNull()).alias("n_unlabelled"),
        F.sum("occupancy_mode").cast("bigint").alias("label_sum"), F.min("window_start").alias("first_window"), F.max("window_start").alias("last_window"),
        F.count_if(F.concat(*[F.col(c).cast("string") for c in model.FEATURES]).isNull()).alias("n_missing"), F.sum("is_work_free").alias("n_work_free"),
    )


@query("feature_order_check", f"""SELECT {", ".join(map(_feature_sql, model.FEATURES))}, '{",".join(model.FEATURES)}' AS column_order FROM {_JOINED}""")
def feature_order_check(t):
    ordered = model.ordered_features(labelled(t))
    return ordered.withColumn("column_order", F.lit(",".join(ordered.columns)))


@query("assemble", f"""SELECT trip_id AS trip_key, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, {", ".join(map(_number_sql, model.FEATURES))}
    FROM {_JOINED} WHERE occupancy_mode IS NOT NULL""")
def assemble(t):
    """The slots of the feature vector, each under the name of its feature; missing values are NaN in it."""
    rows = labelled(t).na.drop(subset=["occupancy_mode"]).withColumn("trip_key", F.col("trip_id"))
    vector = model.assemble(flags_to_int(ids_to_int(rows))).select("trip_key", "window_start", vector_to_array("features").alias("v"))
    slots = {name: F.nanvl(F.col("v")[i], F.lit(None).cast("double")) for i, name in enumerate(model.FEATURES)}
    return vector.withColumns(slots).drop("v")


@query("train_weighted")
def train_weighted(t):
    """Train, then test quality of the fitted classifier."""
    scored = model.model_scorer(trained(t))(split(t)[1])
    return weighted_metrics(scored, "occupancy_mode", "predicted_occupancy")


@query("score_batch")
def score_batch(t):
    scored = model.model_scorer(trained(t))(split(t)[1])
    return scored.select("window_start", "trip_id", "occupancy_mode", "predicted_occupancy", "confidence")


@query("importance_rank")
def importance_rank(t):
    return model.importance_rank(trained(t))


_PERMUTED = ["hour", "day_of_week", "is_work_free", "is_red_day"]
_DEALT = ", ".join(f"CASE WHEN feature = '{c}' THEN d.{c} ELSE r.{c} END AS {c}" for c in _PERMUTED)


@query("permutation_importance", f"""WITH k AS (SELECT *, md5(trip_id || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S')) AS key FROM flagged WHERE occupancy_mode IS NOT NULL),
    b AS (SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % greatest(1, ceil(count(*) OVER () / {model.PERMUTED_ROWS})::BIGINT) AS block FROM k),
    r AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY key) AS place, row_number() OVER (PARTITION BY block ORDER BY md5('{model.SEED}|' || key)) AS dealt FROM b),
    c AS (SELECT f.feature, r.occupancy_mode, {_DEALT} FROM r JOIN r d ON d.block = r.block AND d.dealt = r.place CROSS JOIN (SELECT unnest([NULL, {", ".join(f"'{c}'" for c in _PERMUTED)}]) AS feature) f),
    a AS (SELECT feature, count(*) AS n_rows, avg((({_RULE}) = occupancy_mode)::INTEGER) AS accuracy FROM c GROUP BY 1)
    SELECT feature, n_rows, round(accuracy, 7) AS accuracy, round((SELECT accuracy FROM a WHERE feature IS NULL) - accuracy, 7) AS "drop" FROM a""")
def permutation_importance(t):
    """The time-of-day rule as scorer: what it loses without each feature."""
    return model.permutation_importance(labelled(t), model.rule_scorer, ["trip_id", "window_start"], _PERMUTED)


@query("permutation_importance_model")
def permutation_importance_model(t):
    """What the trained model loses without each feature, on the test rows."""
    test = split(t)[1].withColumn("row_key", F.concat_ws("|", "trip_id", "vehicle_id", "window_start"))
    return model.permutation_importance(test, model.model_scorer(trained(t)), ["row_key"])


@query("hindcast_model")
def hindcast_model(t):
    scorer = model.model_scorer(trained(t))
    return inference.hindcast(t.windows, t.weather, t.holidays, "2024-01-29", scorer, generated_at="2024-01-30 10:30:00")


@query("grid_forecast_model")
def grid_forecast_model(t):
    """Class mix of the map when the trained model scores the grid."""
    scorer = model.model_scorer(trained(t))
    cells = inference.grid_forecast(last_days(t), stop_box(t), t.weather, t.holidays, scorer)
    return cells.groupBy("hour", "weekday", "predicted_occupancy").agg(F.count("*").alias("n_cells"), F.avg("confidence").alias("confidence"))


@query("trip_forecast_model")
def trip_forecast_model(t):
    scorer = model.model_scorer(trained(t))
    trips = t.routes.withColumnRenamed("route_id", "trip_id")
    return inference.trip_forecast(trips, t.weather, t.holidays, today(t), scorer, generated_at="2024-01-30 10:30:00")


@query("ordinal_model")
def ordinal_model(t):
    train, test = split(t)
    scored = model.score_ordinal(model.train_ordinal(train), test)
    return scored.select("window_start", "trip_id", "occupancy_mode", "predicted_occupancy")


@query("random_search")
def random_search(t):
    train, _ = split(t)
    return model.search_results(model.random_search(train))


@query("tune_features", """SELECT trip_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, round(max_speed, 7) AS max_speed, CAST(n_positions AS BIGINT) AS n_positions FROM windows""")
def tune_features(t):
    narrow = model.drop_weak_features(t.windows.select("trip_id", "window_start", "avg_speed", "max_speed", "speed_std", "n_positions"))
    return narrow
