"""Training, scoring and evaluation of the occupancy classifier."""

from __future__ import annotations

import random
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from headway.functions.occupancy import RULE_CONFIDENCE, ordinal_class, rule_class, top_class, top_confidence
from headway.operators.cleaning import flags_to_int, ids_to_int, impute_medians, numeric_columns
from headway.operators.enrich import HOLIDAY_FEATURES
from headway.operators.metrics import class_report, pair_counts, with_class_weight
from headway.operators.ranks import split_by_date, split_by_ratio
from headway.plans.boosting import Booster, Settings, fit
from headway.session import written

TARGET = "occupancy_mode"

# Model features in order, and columns that are never features.
FEATURES = [
    "trip_id", "vehicle_id", "max_speed", "n_positions", "lat_min", "lat_max", "lat_mean", "lon_min", "lon_max",
    "lon_mean", "bearing_min", "bearing_max", "hour", "day_of_week", "temperature_2m", "precipitation", "cloud_cover",
    "wind_speed_10m", "rain", "snowfall", "is_work_free", "is_red_day", "is_day_before_holiday",
]
NOT_FEATURES = [TARGET, "window_start", "date", "speed_std", "avg_speed"]

SEED = 42
# rows of one block of a permutation, copies of rows that one task scores
PERMUTED_ROWS, COPIES = 4096, 32_768

Scorer = Callable[[DataFrame], DataFrame]


def select_features(df: DataFrame) -> DataFrame:
    """Everything but the label, the instants and the weak speed columns."""
    return df.drop(*NOT_FEATURES)


def drop_weak_features(df: DataFrame, columns=("speed_std", "avg_speed")) -> DataFrame:
    return df.drop(*columns)


class MissingFeatures(ValueError):
    """Model input lacks feature columns."""


def ordered_features(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Model input in the fixed column order; names what is missing."""
    missing = [c for c in FEATURES if c not in df.columns]
    if missing:
        raise MissingFeatures(f"missing model columns: {missing}")
    return df.select(*[c for c in keep if c not in FEATURES], *FEATURES)


def prepare(df: DataFrame, test_start=None, test_ratio: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test frames: labelled rows, time split, train medians, numeric ids and flags."""
    # the split and the medians read the rows several times
    labelled = written(df.na.drop(subset=[TARGET]), "training")
    flagged = split_by_date(labelled, test_start) if test_start else split_by_ratio(labelled, test_ratio=test_ratio)
    numbers = [c for c in numeric_columns(select_features(labelled))]
    train, test = impute_medians(
        flagged.filter("is_train"), [flagged.filter("is_train"), flagged.filter(~F.col("is_train"))], numbers
    )
    return tuple(flags_to_int(ids_to_int(f.drop("is_train")), HOLIDAY_FEATURES) for f in (train, test))


def assemble(df: DataFrame) -> DataFrame:
    """Feature vector column; missing values stay in as NaN."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(df)


def train(train_df: DataFrame, settings: Settings = Settings(), use_class_weights: bool = True) -> Booster:
    """Boosted trees with a softmax over the classes, over the fixed feature order."""
    rows = with_class_weight(train_df, TARGET) if use_class_weights else train_df.withColumn("class_weight", F.lit(1.0))
    return fit(rows, FEATURES, TARGET, "class_weight", settings)


def model_scorer(model: Booster) -> Scorer:
    """Batch scorer that adds the most likely class and its probability."""

    def score(df: DataFrame) -> DataFrame:
        names = {"predicted_occupancy": top_class(F.col("_probability")), "confidence": top_confidence(F.col("_probability"))}
        return model.scored(df, "_probability").withColumns(names).drop("_probability")

    return score


def score_stored(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Class and confidence of every row by the model stored at `path`."""
    return model_scorer(Booster.load(spark, path))(df)


def rule_scorer(df: DataFrame) -> DataFrame:
    """Scorer without a model: the time-of-day rule."""
    rule = rule_class(F.col("hour"), F.col("is_work_free").cast("boolean"), F.col("is_red_day").cast("boolean"))
    return df.withColumns({"predicted_occupancy": rule, "confidence": F.lit(RULE_CONFIDENCE)})


def importance_rank(model: Booster) -> DataFrame:
    """Features by falling mean gain of their splits; one row per feature."""
    rows = SparkSession.active().createDataFrame(model.importances(), "feature string, importance double")
    return rows.orderBy(F.col("importance").desc(), "feature")


def permutation_importance(rows: DataFrame, scorer: Scorer, key: list[str], features: list[str] = FEATURES, seed: int = SEED) -> DataFrame:
    """How much accuracy is lost when the values of one feature are dealt anew: feature, n_rows, accuracy, drop.

    Each row takes one feature's value from a donor of its block: the row whose place in a seeded order is its
    own place in another one. One join finds all donors, and one scoring pass covers the rows as they are
    (feature null) and with each feature replaced. Blocks are dealt by hash and hold about PERMUTED_ROWS rows,
    so no sort grows with the table. Rows need distinct keys.
    """
    named = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    known = rows.filter(F.col(TARGET).isNotNull()).withColumn("_key", F.md5(named))
    many = known.count()
    block = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint") % max(1, -(-many // PERMUTED_ROWS))
    placed = known.withColumn("_block", block)
    place = F.row_number().over(Window.partitionBy("_block").orderBy("_key"))
    dealt = F.row_number().over(Window.partitionBy("_block").orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("_key")))))
    donors = placed.select("_block", dealt.alias("_place"), F.struct(*features).alias("_donor"))
    paired = placed.withColumn("_place", place).join(donors, ["_block", "_place"])
    # a number, as few bytes become many copies to be scored
    paired = paired.repartition(max(1, -(-many * (len(features) + 1) // COPIES)))
    copies = paired.withColumn("_feature", F.explode(F.array(F.lit(None).cast("string"), *map(F.lit, features))))
    changed = copies.withColumns({c: F.when(F.col("_feature") == c, F.col("_donor")[c]).otherwise(F.col(c)) for c in features})
    scored = scorer(changed.drop("_donor")).groupBy(F.col("_feature").alias("feature")).agg(
        F.count("*").alias("n_rows"), F.avg((F.col("predicted_occupancy") == F.col(TARGET)).cast("double")).alias("accuracy"))
    # the window holds one row for each feature and one for the rows as they are
    plain = F.max(F.when(F.col("feature").isNull(), F.col("accuracy"))).over(Window.partitionBy(F.lit(1)))
    return scored.withColumn("drop", plain - F.col("accuracy"))


def train_ordinal(train_df: DataFrame, rounds: int = 20, depth: int = 5) -> dict[str, PipelineModel]:
    """Three binary boosted models for occupancy >= 1, 2 and 3, fitted side by side: their levels are short jobs."""

    def fitted(k: int) -> PipelineModel:
        rows = train_df.withColumn("label", (F.col(TARGET) >= k).cast("double"))
        stages = [
            VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"),
            GBTClassifier(labelCol="label", maxIter=rounds, maxDepth=depth, seed=SEED),
        ]
        return Pipeline(stages=stages).fit(rows)

    levels = (1, 2, 3)
    with ThreadPool(len(levels)) as pool:
        models = pool.map(inheritable_thread_target(train_df.sparkSession)(fitted), levels)
    return {f"ge_{k}": model for k, model in zip(levels, models)}


def score_ordinal(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Chain of the three threshold models."""
    out = df
    for name, model in models.items():
        scored = model.transform(out)
        out = scored.withColumn(f"p_{name}", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )
    return out.withColumn("predicted_occupancy", ordinal_class(F.col("p_ge_1"), F.col("p_ge_2"), F.col("p_ge_3")))


class MacroRecall(Evaluator):
    """Mean recall over the classes that occur."""

    def _evaluate(self, dataset: DataFrame) -> float:
        report = class_report(pair_counts(dataset, "label", "prediction"))
        return report.filter(F.col("class") == "macro avg").first()["recall"]

    def isLargerBetter(self) -> bool:
        return True


def random_search(train_df: DataFrame, draws: int = 20, folds: int = 2, parallelism: int = 4) -> CrossValidatorModel:
    """Cross-validated search over randomly drawn tree settings, scored by macro recall."""
    rows = with_class_weight(train_df, TARGET).withColumn("label", F.col(TARGET).cast("double"))
    forest = RandomForestClassifier(labelCol="label", weightCol="class_weight", seed=SEED)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"), forest])
    dice = random.Random(SEED)
    maps = [
        {
            forest.maxDepth: dice.randrange(3, 10),
            forest.numTrees: dice.randrange(100, 300),
            forest.subsamplingRate: dice.uniform(0.6, 1.0),
            forest.minInstancesPerNode: dice.randrange(1, 10),
        }
        for _ in range(draws)
    ]
    search = CrossValidator(
        estimator=pipeline, estimatorParamMaps=maps, evaluator=MacroRecall(), numFolds=folds,
        parallelism=parallelism, seed=SEED,
    )
    return search.fit(rows)


def search_results(found: CrossValidatorModel) -> DataFrame:
    """One row per draw with its settings and mean score."""
    rows = [
        (i, *(value for _, value in sorted(((p.name, float(v)) for p, v in m.items()))), float(score))
        for i, (m, score) in enumerate(zip(found.getEstimatorParamMaps(), found.avgMetrics))
    ]
    names = sorted(p.name for p in found.getEstimatorParamMaps()[0])
    schema = "draw int, " + ", ".join(f"{n} double" for n in names) + ", macro_recall double"
    return SparkSession.active().createDataFrame(rows, schema)
