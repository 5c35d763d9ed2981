"""Class statistics, weights, model quality and monitoring tables.

Everything that compares classes first counts (actual, predicted) pairs, which
leaves at most a few dozen rows however long the table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from headway.functions.occupancy import CLASSES, occupancy_dim
from headway.operators.ranks import quantiles
from headway.session import written

# Weight multiplier per class and the upper weight limit.
CLASS_MULTIPLIERS = {0: 1.0, 1: 2.0, 2: 10.0, 3: 20.0, 4: 30.0, 5: 30.0, 6: 30.0}
MAX_WEIGHT = 50.0

# Accuracy alert limit and (low, high) card limits per metric.
ALERT_BELOW = 0.65
CARD_LIMITS = {"accuracy": (0.60, 0.70), "f1_weighted": (0.55, 0.65), "precision": (0.55, 0.70), "mae": (0.3, 0.6)}

CURRENT_MODEL_VERSION = 4


def share_of_total(counts: DataFrame, count: str = "n_rows", percent: str = "percent") -> DataFrame:
    """Add each count's percentage of the sum; runs over one row per counted value."""
    return counts.withColumn(percent, 100.0 * F.col(count) / F.sum(count).over(Window.partitionBy()))


def class_distribution(df: DataFrame, label: str = "occupancy_mode") -> DataFrame:
    return share_of_total(df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows")))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts and shares of the values of several text columns: (field, value, n_rows, percent)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("field", "value").agg(F.count("*").alias("n_rows"))
    )
    # one total per listed column
    totals = F.broadcast(counts.groupBy("field").agg(F.sum("n_rows").alias("_total")))
    return counts.join(totals, "field").withColumn("percent", 100.0 * F.col("n_rows") / F.col("_total")).drop("_total")


def class_weights(
    df: DataFrame, label: str = "occupancy_mode", multipliers: dict | None = None, cap: float | None = MAX_WEIGHT
) -> DataFrame:
    """Balanced weight n / (k * n_class) times the class multiplier, capped unless cap is None."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))
    # totals over one row per class
    whole = Window.partitionBy()
    factor = F.lit(1.0)
    for cls, value in (multipliers or CLASS_MULTIPLIERS).items():
        factor = F.when(F.col(label) == cls, F.lit(value)).otherwise(factor)
    balanced = F.sum("n_rows").over(whole) / (F.count("*").over(whole) * F.col("n_rows"))
    weight = balanced * factor if cap is None else F.least(balanced * factor, F.lit(cap))
    return counts.select(
        label, "n_rows", balanced.alias("balanced_weight"), weight.alias("class_weight")
    )


def with_class_weight(df: DataFrame, label: str = "occupancy_mode", **options) -> DataFrame:
    """Attach the weight of each row's class.

    The weights are written first, one row per class: with their size known
    the rows are not shuffled onto the few, very uneven label values.
    """
    weights = written(class_weights(df, label, **options).select(label, "class_weight"), "weights")
    return df.join(weights, label, "left")


def pair_counts(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    return (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(*by, F.col(actual).cast("int").alias("actual"), F.col(predicted).cast("int").alias("predicted"))
        .agg(F.count("*").alias("n"))
    )


def _per_class(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Support, predicted count, hits and class distance per class present on either side."""
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), n).otherwise(none)
    off = F.abs(F.col("actual") - F.col("predicted")) * n
    names = ["class", "support", "pred_count", "hits", "off"]
    sides = F.array(
        *[
            F.struct(*[c.alias(name) for c, name in zip(columns, names)])
            for columns in ((F.col("actual"), n, none, hit, off), (F.col("predicted"), none, n, none, none))
        ]
    )
    return pairs.select(*by, F.inline(sides)).groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _zero_safe(numerator, denominator) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _with_rates(per_class: DataFrame) -> DataFrame:
    precision = _zero_safe(F.col("hits"), F.col("pred_count"))
    recall = _zero_safe(F.col("hits"), F.col("support"))
    f1 = _zero_safe(2 * F.col("hits"), F.col("pred_count") + F.col("support"))
    return per_class.withColumns({"precision": precision, "recall": recall, "f1": f1})


def weighted_metrics_from_pairs(pairs: DataFrame, by: list[str] = ()) -> DataFrame:
    """Accuracy, support-weighted precision, recall, F1 and class MAE, per `by` group."""
    by = list(by)
    rates = _with_rates(_per_class(pairs, by))

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    return rates.groupBy(*by).agg(
        F.sum("support").alias("n_rows"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1_weighted"),
        (F.sum("off") / F.sum("support")).alias("mae"),
    )


def weighted_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    return weighted_metrics_from_pairs(pair_counts(df, actual, predicted, list(by)), by)


def confusion_matrix(pairs: DataFrame, classes: list[int] = CLASSES) -> DataFrame:
    """One row per actual class that occurs, one count column per predicted class."""
    cells = [F.sum(F.when(F.col("predicted") == c, F.col("n")).otherwise(0)).alias(f"pred_{c}") for c in classes]
    return pairs.groupBy("actual").agg(*cells)


def class_report(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted average rows."""
    rates = _with_rates(_per_class(pairs, []))
    columns = ["precision", "recall", "f1"]
    rows = rates.select(F.col("class").cast("string").alias("class"), *columns, "support")
    macro = rates.agg(*[F.avg(c).alias(c) for c in columns], F.sum("support").alias("support"))
    weighted = rates.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in columns],
        F.sum("support").alias("support"),
    )
    named = [a.select(F.lit(n).alias("class"), *columns, "support") for n, a in (("macro avg", macro), ("weighted avg", weighted))]
    return rows.unionByName(named[0]).unionByName(named[1])


def class_panel(df: DataFrame, actual: str = "actual_occupancy_mode", predicted: str = "predicted_occupancy_mode") -> DataFrame:
    """All seven classes with counts; recall or precision is null where there is nothing to divide."""
    seen = _per_class(pair_counts(df, actual, predicted), [])
    spine = occupancy_dim(df.sparkSession).select("class", "label")
    # at most one row per class on either side
    panel = spine.join(F.broadcast(seen), "class", "left")
    return panel.select(
        "class", "label",
        F.coalesce("support", F.lit(0)).alias("actual_count"),
        F.coalesce("pred_count", F.lit(0)).alias("pred_count"),
        F.try_divide("hits", "support").alias("recall"),
        F.try_divide("hits", "pred_count").alias("precision"),
    )


MONITOR_METRICS = ["accuracy", "precision", "recall", "f1_weighted", "mae", "model_version"]


def daily_metrics(monitor: DataFrame) -> DataFrame:
    """Per date the first non-null value of each run metric, first in window and trip order."""
    order = F.struct("window_start", "trip_id")
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in MONITOR_METRICS]
    return monitor.groupBy(F.to_date("window_start").alias("date")).agg(*aggs)


def hourly_comparison(monitor: DataFrame) -> DataFrame:
    return monitor.groupBy(F.date_trunc("hour", "window_start").alias("hour_start")).agg(
        F.avg("actual_occupancy_mode").alias("actual_mean"), F.avg("predicted_occupancy_mode").alias("predicted_mean")
    )


def version_filter(monitor: DataFrame, current: int = CURRENT_MODEL_VERSION, chosen: int | None = None) -> DataFrame:
    """Rows of the chosen version; by default the current one, or the newest when it is absent."""
    version = F.col("model_version")
    if chosen is not None:
        return monitor.filter(version == F.lit(chosen))
    # stops at the first row of the current version
    rows = monitor.filter(version == F.lit(current))
    if not rows.isEmpty():
        return rows
    newest = monitor.agg(F.max(version)).first()[0]
    return monitor.filter(version == F.lit(newest))


def day_delta(daily: DataFrame) -> DataFrame:
    """Change of accuracy to the previous available date; works on one row per day."""
    previous = F.lag("accuracy").over(Window.orderBy("date"))
    delta = F.col("accuracy") - previous
    trend = F.when(delta > 0, "up").when(delta < 0, "down").when(delta == 0, "flat")
    return daily.select("date", "accuracy", delta.alias("delta"), trend.alias("trend"))


def latest_daily(daily: DataFrame) -> DataFrame:
    return daily.orderBy(F.col("date").desc()).limit(1)


def latest_rows(monitor: DataFrame, n: int = 100) -> DataFrame:
    """Newest rows of the table, a distributed top-n."""
    return monitor.orderBy(F.col("window_start").desc(), F.col("trip_id")).limit(n)


def drift_alert(latest: DataFrame, below: float = ALERT_BELOW) -> DataFrame:
    """Alert flag and card band per metric; a low error counts as good."""

    def band(metric: str) -> Column:
        low, high = CARD_LIMITS[metric]
        value = F.col(metric)
        if metric == "mae":
            return F.when(value < low, "good").when(value >= high, "bad").otherwise("fair")
        return F.when(value < low, "bad").when(value >= high, "good").otherwise("fair")

    return latest.withColumns(
        {"alert": F.col("accuracy") < below, **{f"{m}_band": F.when(F.col(m).isNotNull(), band(m)) for m in CARD_LIMITS}}
    )


def match_rate(features: DataFrame) -> DataFrame:
    """Windows, windows near an incident, and their share in percent."""
    return features.agg(
        F.count("*").alias("total_windows"),
        F.count_if(F.col("has_nearby_event") == 1).alias("matched_windows"),
    ).withColumn("match_percent", 100.0 * F.try_divide("matched_windows", "total_windows"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column, one row per column."""
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    row = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
            *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ("q25", "q50", "q75"))],
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def available_dates(windows: DataFrame, last: int = 5) -> DataFrame:
    """The newest dates of the table with their row counts; a stored window table counts by its partition column."""
    day = F.col("date") if "date" in windows.columns else F.to_date("window_start")
    return (
        windows.groupBy(day.alias("date")).agg(F.count("*").alias("n_rows"))
        .orderBy(F.col("date").desc()).limit(last)
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


class GateFailed(ValueError):
    """A not-null expectation was violated."""


def not_null_gate(df: DataFrame, columns: list[str], name: str = "dataset") -> DataFrame:
    """Raise when a required column holds nulls, else hand the table through."""
    row = null_counts(df, columns).first()
    failed = {c: row[c] for c in columns if row[c]}
    if failed:
        raise GateFailed(f"{name}: nulls found in {failed}")
    return df


class NullCounts:
    """Nulls of required columns, counted by the pass that reads the rows anyway."""

    def __init__(self, columns: list[str], name: str = "dataset"):
        self.columns, self.name, self.seen = columns, name, None

    def watch(self, df: DataFrame) -> DataFrame:
        """The same rows; whatever action runs over them counts."""
        if not self.columns:
            return df
        self.seen = Observation()
        return df.observe(self.seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in self.columns])

    def check(self) -> None:
        """Raise when the action that ran found nulls."""
        if self.seen is not None:
            failed = {c: n for c, n in self.seen.get.items() if n}
            if failed:
                raise GateFailed(f"{self.name}: nulls found in {failed}")
