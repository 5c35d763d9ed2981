"""Learned steps on rows with a clear signal: the model must find it."""

from threading import Barrier

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from headway.operators import metrics
from headway.plans import model
from headway.plans.boosting import Settings


@pytest.fixture(scope="module")
def rows(spark):
    hour = (F.col("id") % 24).cast("int")
    base = spark.range(2400).select(
        F.concat(F.lit("10"), F.col("id") % 20).alias("trip_id"), (F.col("id") % 9).cast("string").alias("vehicle_id"),
        F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("window_start"), hour.alias("hour"),
        F.when(hour < 12, 0).when(hour < 20, 1).otherwise(3).alias("occupancy_mode"),
        F.weekday(F.timestamp_seconds(1704067200 + F.col("id") * 3600)).alias("day_of_week"),
        *[F.lit(False).alias(c) for c in ("is_work_free", "is_red_day", "is_day_before_holiday")],
    )
    done = set(base.columns)
    noise = [F.when(F.col("id") % 50 > 0, F.rand(i)).alias(c) for i, c in enumerate(model.FEATURES) if c not in done]
    return base.withColumn("id", F.monotonically_increasing_id()).select("*", *noise).drop("id")


@pytest.fixture(scope="module")
def parts(rows):
    return model.prepare(rows)


def test_prepare(parts):
    train, test = parts
    assert (train.count(), test.count()) == (1920, 480)
    assert train.agg(F.max("window_start")).first()[0] < test.agg(F.min("window_start")).first()[0]
    assert train.filter(F.col("max_speed").isNull()).isEmpty()
    by_date = model.prepare(train.unionByName(test).drop("date"), test_start="2024-03-01")
    assert by_date[0].count() == 60 * 24


def test_learns_and_ranks(parts):
    train, test = parts
    fitted = model.train(train, Settings(rounds=10, depth=4, rate=0.3))
    scored = model.model_scorer(fitted)(test)
    assert metrics.weighted_metrics(scored, "occupancy_mode", "predicted_occupancy").first()["accuracy"] > 0.95
    assert scored.filter((F.col("confidence") < 0) | (F.col("confidence") > 1)).isEmpty()
    ranked = model.importance_rank(fitted).collect()
    assert ranked[0]["feature"] == "hour" and len(ranked) == 23
    assert sum(r["importance"] for r in ranked) == pytest.approx(1.0)


def test_permutation_finds_the_planted_feature(spark, parts, monkeypatch):
    train, test = parts
    fitted = model.train(train, Settings(rounds=6, depth=3, rate=0.3))
    for rows in (4096, 50):
        monkeypatch.setattr(model, "PERMUTED_ROWS", rows)
        found = {r["feature"]: r for r in model.permutation_importance(test, model.model_scorer(fitted), ["window_start"]).collect()}
        assert len(found) == 24 and all(r["n_rows"] == 480 for r in found.values())
        assert found[None]["drop"] == 0 and found["hour"]["drop"] > 0.2 == max(0.2, *(r["drop"] for f, r in found.items() if f != "hour"))


def test_stored_model_scores_alike(spark, parts, tmp_path):
    train, test = parts
    fitted = model.train(train, Settings(rounds=3, depth=3), use_class_weights=False)
    fitted.save(spark, str(tmp_path / "model"))
    columns = "window_start", "trip_id", "predicted_occupancy", "confidence"
    wanted = sorted(map(tuple, model.model_scorer(fitted)(test).select(*columns).collect()))
    assert sorted(map(tuple, model.score_stored(spark, str(tmp_path / "model"), test).select(*columns).collect())) == wanted


def test_ordinal_models(parts):
    train, test = parts
    scored = model.score_ordinal(model.train_ordinal(train, rounds=3, depth=3), test)
    assert metrics.weighted_metrics(scored, "occupancy_mode", "predicted_occupancy").first()["accuracy"] > 0.95


def test_ordinal_levels_are_fitted_side_by_side(parts, monkeypatch):
    all_at_once = Barrier(3, timeout=30)

    class Waiting(Pipeline):
        def fit(self, rows):
            all_at_once.wait()
            return rows.agg(F.sum("label")).first()[0]

    monkeypatch.setattr(model, "Pipeline", Waiting)
    found = model.train_ordinal(parts[0])
    assert list(found) == ["ge_1", "ge_2", "ge_3"]
    assert list(found.values()) == [parts[0].filter(F.col("occupancy_mode") >= k).count() for k in (1, 2, 3)]


def test_random_search(spark, parts):
    found = model.random_search(parts[0], draws=2)
    table = model.search_results(found).collect()
    assert len(table) == 2 and all(0 <= r["macro_recall"] <= 1 for r in table)


def test_macro_recall(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    assert model.MacroRecall().evaluate(df) == pytest.approx(0.75)


def test_copies_of_a_permutation_are_dealt_by_number(parts, monkeypatch):
    """Few bytes become many rows to score, so their tasks are made by rows."""
    monkeypatch.setattr(model, "COPIES", 1000)
    found = model.permutation_importance(parts[1], model.rule_scorer, ["window_start"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # 480 rows, as they are and with each of the features changed
    assert "Repartition 12, true" in plan


def test_a_query_prepares_its_rows_once(monkeypatch):
    from headway.suite import models

    made = []
    monkeypatch.setattr(models, "labelled", lambda t: t)
    monkeypatch.setattr(models.model, "prepare", lambda rows: made.append(rows) or ("train", "test"))

    class Tables:
        pass

    t = Tables()
    assert models.split(t) == models.split(t) == ("train", "test") and made == [t]
