import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators import metrics

# confusion matrices published for a test set of 1,230,321 rows; rows actual, columns predicted
BEFORE = [[695374, 164465, 0, 0], [109338, 238526, 0, 0], [3061, 13827, 0, 0], [452, 5278, 0, 0]]
AFTER = [[504667, 177221, 70406, 107545], [3972, 121577, 80509, 141806], [54, 2262, 6283, 8289], [0, 913, 1228, 3589]]


def pairs(spark, matrix):
    rows = [(a, p, n) for a, row in enumerate(matrix) for p, n in enumerate(row) if n]
    return spark.createDataFrame(rows, "actual int, predicted int, n long")


@pytest.mark.parametrize("matrix, wanted", [
    (BEFORE, (0.759070, 0.761069, 0.759070, 0.757867, 0.248442)),
    (AFTER, (0.517033, 0.807786, 0.517033, 0.622345, 0.831063)),
])
def test_published_matrices(spark, matrix, wanted):
    row = metrics.weighted_metrics_from_pairs(pairs(spark, matrix)).first()
    got = (row["accuracy"], row["precision"], row["recall"], row["f1_weighted"], row["mae"])
    assert got == pytest.approx(wanted, abs=1e-6) and row["n_rows"] == 1230321


def test_published_recalls_and_report(spark):
    report = {r["class"]: r for r in metrics.class_report(pairs(spark, AFTER)).collect()}
    assert [report[str(c)]["recall"] for c in range(4)] == pytest.approx([0.586932, 0.349496, 0.372039, 0.626353], abs=1e-6)
    assert report["macro avg"]["support"] == report["weighted avg"]["support"] == 1230321
    assert report["weighted avg"]["recall"] == pytest.approx(0.517033, abs=1e-6)


def test_matrix_columns(spark):
    rows = {r["actual"]: r for r in metrics.confusion_matrix(pairs(spark, BEFORE)).collect()}
    assert [rows[1][f"pred_{c}"] for c in range(7)] == [109338, 238526, 0, 0, 0, 0, 0]


def test_class_weights_of_published_supports(spark):
    supports = [859839, 347864, 16888, 5730]
    # one weighted row per class would change the counts: use a small frame with the same proportions per class
    scale = [s // 10 for s in supports]
    parts = [spark.range(n).select(F.lit(c).alias("occupancy_mode")) for c, n in enumerate(scale)]
    df = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    rows = {r["occupancy_mode"]: r for r in metrics.class_weights(df).collect()}
    assert [rows[c]["balanced_weight"] for c in range(4)] == pytest.approx([0.357718, 0.884197, 18.212947, 53.678927], rel=1e-3)
    assert [rows[c]["class_weight"] for c in range(4)] == pytest.approx([0.357718, 1.768394, 50, 50], rel=1e-3)
    uncapped = {r["occupancy_mode"]: r["class_weight"] for r in metrics.class_weights(df, cap=None).collect()}
    assert uncapped[3] == pytest.approx(53.678927 * 20, rel=1e-3)


def test_weight_join_does_not_shuffle_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("int").alias("occupancy_mode"), "id")
    weighted = metrics.with_class_weight(df)
    assert "BroadcastHashJoin" in weighted._jdf.queryExecution().executedPlan().toString()
    assert weighted.count() == 1000


def test_classes_missing_on_either_side(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (None, 1)], "a int, p int")
    panel = {r["class"]: r for r in metrics.class_panel(df, "a", "p").collect()}
    assert len(panel) == 7
    assert (panel[5]["actual_count"], panel[5]["pred_count"], panel[5]["recall"], panel[5]["precision"]) == (0, 0, None, None)
    assert (panel[2]["recall"], panel[2]["precision"], panel[0]["recall"]) == (None, 0.0, 0.5)
    report = {r["class"]: r for r in metrics.class_report(metrics.pair_counts(df, "a", "p")).collect()}
    assert report["2"]["recall"] == 0.0 and report["2"]["support"] == 0


MONITOR = "window_start timestamp, trip_id string, actual_occupancy_mode int, predicted_occupancy_mode int, accuracy double, precision double, recall double, f1_weighted double, mae double, model_version int"


def monitor(spark):
    rows = []
    for day, acc in ((1, 0.7), (2, 0.6), (4, 0.6)):
        for minute in range(3):
            # the first row of the day lacks the metric
            value = None if minute == 0 else acc
            rows.append((dt.datetime(2024, 1, day, 8, minute), f"t{minute}", 1, minute, value, 0.5, 0.5, 0.5, 0.2, day))
    return spark.createDataFrame(rows, MONITOR)


def test_daily_metrics_take_first_known_value(spark):
    daily = metrics.daily_metrics(monitor(spark))
    assert [(r["date"].day, r["accuracy"]) for r in daily.orderBy("date").collect()] == [(1, 0.7), (2, 0.6), (4, 0.6)]
    deltas = metrics.day_delta(daily).orderBy("date").collect()
    assert [r["trend"] for r in deltas] == [None, "down", "flat"]
    latest = metrics.drift_alert(metrics.latest_daily(daily)).first()
    assert latest["alert"] and latest["mae_band"] == "good" and latest["accuracy_band"] == "fair"


def test_version_choice(spark):
    df = monitor(spark)
    assert {r["model_version"] for r in metrics.version_filter(df).collect()} == {4}
    assert {r["model_version"] for r in metrics.version_filter(df, current=9).collect()} == {4}
    assert {r["model_version"] for r in metrics.version_filter(df, chosen=1).collect()} == {1}


def test_gate_names_the_column(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    assert metrics.not_null_gate(df, ["k"]) is df
    with pytest.raises(metrics.GateFailed, match="'v': 1"):
        metrics.not_null_gate(df, ["k", "v"])


def test_latest_rows_is_a_top_n(spark):
    plan = metrics.latest_rows(monitor(spark), 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
