import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators.windows import (
    first_per_key, lag_features, last_per_key, merged_states, mode_per_key, trip_windows, window_states, windows_of_states,
)

PING = "trip_id string, timestamp timestamp, vehicle_id string, speed double, position_lat double, position_lon double, bearing double, occupancy_status int"
T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def pings(spark, rows):
    full = [(t, T0 + dt.timedelta(seconds=s), v, sp, 58.0, 15.0, 10.0, o) for t, s, v, sp, o in rows]
    return spark.createDataFrame(full, PING)


def test_window_rules(spark):
    rows = [
        ("a", 0, "v1", 1.0, 2), ("a", 20, "v2", None, 1), ("a", 40, "v1", 3.0, 2), ("a", 59, "v2", 5.0, 1),
        ("a", 60, "v9", 7.0, None), (None, 0, "v1", 1.0, 1), ("", 0, "v1", 1.0, 1), ("a", 0, " ", 1.0, 6),
    ]
    got = {r["window_start"].minute: r for r in trip_windows(pings(spark, rows)).collect()}
    assert set(got) == {0, 1}
    first = got[0]
    # ties of the mode go to the lowest value, speed counts skip nulls
    assert (first["vehicle_id"], first["occupancy_mode"], first["n_positions"]) == ("v1", 1, 3)
    assert (first["avg_speed"], first["max_speed"]) == (3.0, 5.0)
    assert first["speed_std"] == pytest.approx(2.0)
    assert (first["date"], first["hour"], first["day_of_week"]) == (dt.date(2024, 1, 1), 8, 0)
    assert got[1]["speed_std"] is None and got[1]["occupancy_mode"] is None


def test_empty_input_gives_no_windows(spark):
    assert trip_windows(pings(spark, [])).isEmpty()


def test_hot_trip_gives_same_result_as_pandas(spark):
    """One trip and minute holds most rows, with many vehicles."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("trip_id"),
        F.lit(T0).alias("timestamp"), F.concat(F.lit("v"), F.pmod(F.hash("id"), 997)).alias("vehicle_id"),
        (F.col("id") % 17).cast("double").alias("speed"), F.lit(58.0).alias("position_lat"), F.lit(15.0).alias("position_lon"),
        F.lit(1.0).alias("bearing"), F.pmod(F.hash("id"), 5).cast("int").alias("occupancy_status"),
    )
    got = {r["trip_id"]: (r["vehicle_id"], r["occupancy_mode"], r["n_positions"]) for r in trip_windows(df).collect()}
    frame = df.toPandas()
    for trip, group in frame.groupby("trip_id"):
        assert got[trip] == (group.vehicle_id.mode().iloc[0], group.occupancy_status.mode().iloc[0], len(group))


def test_mode_of_only_nulls_has_no_row(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("b", 1)], "k string, v int")
    assert {(r["k"], r["v"]) for r in mode_per_key(df, ["k"], "v").collect()} == {("b", 1)}


def test_one_scan_and_two_exchanges(spark, tmp_path):
    pings(spark, [("a", 0, "v", 1.0, 1)]).write.parquet(f"file://{tmp_path}/p")
    plan = trip_windows(spark.read.parquet(f"file://{tmp_path}/p"))._jdf.queryExecution().executedPlan().toString()
    # states by their key, windows by theirs; the sums of a window need no exchange of their own
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 1 and "Join" not in plan


def test_states_add_up_in_any_division(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id") % 4).alias("trip_id"), F.timestamp_seconds(1704096000 + F.col("id") % 300).alias("timestamp"),
        F.concat(F.lit("v"), F.pmod(F.hash("id"), 5)).alias("vehicle_id"), F.when(F.col("id") % 11 > 0, 1e6 + F.col("id") % 3).alias("speed"),
        (F.col("id") % 90).cast("double").alias("position_lat"), F.lit(None).cast("double").alias("position_lon"),
        F.col("id").cast("double").alias("bearing"), F.when(F.col("id") % 3 > 0, F.pmod(F.hash(F.col("id") + 1), 4)).cast("int").alias("occupancy_status"),
    )
    as_rows = lambda d: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in d.collect())
    whole = as_rows(trip_windows(df))
    parts = [window_states(df.filter(F.col("bearing") % 3 == k)) for k in range(3)]
    appended = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert as_rows(windows_of_states(appended)) == as_rows(windows_of_states(merged_states(appended))) == whole
    assert merged_states(appended).count() == window_states(df).count() < appended.count()
    # the deviation of large numbers keeps its digits
    want = df.groupBy("trip_id", F.date_trunc("minute", "timestamp").alias("window_start")).agg(F.stddev_samp("speed").alias("s")).toPandas().set_index(["trip_id", "window_start"]).s
    got = trip_windows(df).toPandas().set_index(["trip_id", "window_start"]).speed_std
    assert (got - want).abs().max() < 1e-9 and len(got) == len(want) == 20


def test_row_per_key_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    picked = first_per_key(df, ["k"], [F.col("v")])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert {tuple(r) for r in picked.collect()} == {("a", 1), ("b", 3)}
    assert {tuple(r) for r in last_per_key(df, ["k"], ["v"]).collect()} == {("a", 2), ("b", 3)}


@pytest.mark.parametrize("drop", [True, False])
def test_lags_equal_pandas_shift(spark, drop):
    rows = []
    for i in range(400):
        vehicle = "hot" if i % 3 else f"v{i % 7}"
        rows.append((vehicle, f"t{i % 5}", T0 + dt.timedelta(minutes=(i * 37) % 5000), None if i % 11 == 0 else i % 4))
    df = spark.createDataFrame(rows, "vehicle_id string, trip_id string, window_start timestamp, occupancy_mode int")
    df = first_per_key(df, ["vehicle_id", "trip_id", "window_start"], [F.col("occupancy_mode")])
    got = lag_features(df, drop_incomplete=drop).toPandas()
    frame = df.toPandas().sort_values(["window_start", "trip_id"])
    for k in (1, 2, 3):
        frame[f"occupancy_mode_lag_{k}"] = frame.groupby("vehicle_id")["occupancy_mode"].shift(k)
    if drop:
        frame = frame.dropna(subset=[f"occupancy_mode_lag_{k}" for k in (1, 2, 3)])
    key = ["vehicle_id", "window_start", "trip_id"]
    a, b = (f.sort_values(key).reset_index(drop=True)[sorted(frame.columns)].astype(str).replace({"None": "nan", "<NA>": "nan"}) for f in (got, frame))
    for c in a.columns:
        left = [x.removesuffix(".0") for x in a[c]]
        assert left == [x.removesuffix(".0") for x in b[c]], c
