import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.functions import clock, geo, occupancy, values


def one(spark, **columns):
    return spark.range(1).select([c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("text, seconds", [("25:10:00", 90600), ("bad", None), (None, None), ("1:2", None), (" 08:00:01", 28801)])
def test_clock_seconds(spark, text, seconds):
    assert one(spark, s=clock.clock_seconds(F.lit(text).cast("string")))["s"] == seconds


@pytest.mark.parametrize("seconds, text", [(90600, "25:10:00"), (0, "00:00:00"), (3599, "00:59:59"), (360000, "100:00:00")])
def test_clock_text(spark, seconds, text):
    assert one(spark, t=clock.clock_text(F.lit(seconds)))["t"] == text


@pytest.mark.parametrize("local, utc", [("2025-12-25 00:00:00", "2025-12-24 23:00:00"), ("2025-10-26 02:30:00", "2025-10-26 00:30:00"), ("2025-07-01 12:00:00", "2025-07-01 10:00:00")])
def test_local_to_utc(spark, local, utc):
    shifted = clock.local_to_utc(F.lit(local).cast("timestamp"))
    assert one(spark, t=F.date_format(shifted, "yyyy-MM-dd HH:mm:ss"))["t"] == utc


def test_skipped_local_hour_does_not_fail(spark):
    assert one(spark, t=clock.local_to_utc(F.lit("2025-03-30 02:30:00").cast("timestamp")))["t"] is not None


def test_time_parts_monday_is_zero(spark):
    df = spark.sql("select timestamp'2024-01-01 23:30:00' as window_start")
    row = clock.with_time_parts(df).first()
    assert (row["date"], row["hour"], row["day_of_week"]) == (dt.date(2024, 1, 1), 23, 0)
    local = clock.with_time_parts(df, zone="Europe/Stockholm").first()
    assert (local["date"], local["hour"], local["day_of_week"]) == (dt.date(2024, 1, 2), 0, 1)


def test_epoch_zero_is_unknown(spark):
    row = one(spark, a=clock.epoch_instant(F.lit(0)), b=clock.epoch_instant(F.lit(60)), c=clock.epoch_instant(F.lit(None).cast("int")))
    assert row["a"] is None and row["c"] is None and row["b"] is not None


def test_arrival_window_is_inclusive_and_does_not_wrap(spark):
    def inside(a, t):
        return one(spark, x=clock.within_seconds(F.lit(a).cast("int"), F.lit(t)))["x"]

    assert inside(3600, 7200) and inside(10800, 7200)
    assert not inside(3599, 7200) and not inside(None, 7200) and not inside(86390, 0)


@pytest.mark.parametrize("wkt, lat, lon", [
    ("POINT (15.1 58.2)", 58.2, 15.1),
    ("LINESTRING (15.1 58.1, 15.3 58.5)", 58.3, 15.2),
    ("POLYGON ((15 58, 16 58, 16 59, 15 58))", None, None), ("", None, None), (None, None, None),
])
def test_wkt_centroid(spark, wkt, lat, lon):
    c = one(spark, c=geo.wkt_centroid(F.lit(wkt).cast("string")))["c"]
    assert (c["lat"], c["lon"]) == ((None, None) if lat is None else (pytest.approx(lat), pytest.approx(lon)))


@pytest.mark.parametrize("lat, lon, metres", [(58.4158, 15.6253, 600.5857), (58.4148, 15.6253, 499.4255)])
def test_haversine_known_distances(spark, lat, lon, metres):
    got = [
        one(spark, d=geo.haversine_m(F.lit(58.4108), F.lit(15.6214), F.lit(lat), F.lit(lon), r))["d"]
        for r in (geo.LOOKUP_RADIUS_M, geo.MEAN_RADIUS_M)
    ]
    assert min(abs(g - metres) for g in got) < 1e-3


def test_haversine_antipodes_and_nulls(spark):
    row = one(
        spark, d=geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)),
        n=geo.haversine_m(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0)),
    )
    assert row["d"] == pytest.approx(3.141592653589793 * geo.LOOKUP_RADIUS_M) and row["n"] is None


def test_cell_ring(spark):
    ring = one(spark, r=geo.cell_ring(F.lit(58.0), F.lit(15.0), 0.2, 0.4))["r"]
    wanted = [[14.8, 57.9], [15.2, 57.9], [15.2, 58.1], [14.8, 58.1], [14.8, 57.9]]
    assert [[round(x, 9) for x in p] for p in ring] == wanted


@pytest.mark.parametrize("metres, whole", [(0.5, 0), (1.5, 2), (2.5, 2), (2.51, 3)])
def test_metres_round_half_to_even(spark, metres, whole):
    assert one(spark, m=geo.metres_rounded(F.lit(metres)))["m"] == whole


@pytest.mark.parametrize("hour, free, red, cls", [
    (7, False, False, 2), (8, False, False, 3), (17, False, False, 3), (18, False, False, 2), (8, False, True, 1),
    (8, True, False, 1), (12, False, False, 1), (22, False, False, 0), (9, None, None, 3), (5, True, True, 0),
])
def test_rule_class(spark, hour, free, red, cls):
    flags = [F.lit(v).cast("boolean") for v in (free, red)]
    assert one(spark, c=occupancy.rule_class(F.lit(hour), *flags))["c"] == cls


def test_top_class_takes_first_of_equals(spark):
    p = F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))
    row = one(spark, c=occupancy.top_class(p), p=occupancy.top_confidence(p))
    assert (row["c"], row["p"]) == (1, 0.4)


@pytest.mark.parametrize("probabilities, cls", [((0.6, 0.2, 0.9), 3), ((0.6, 0.6, 0.1), 2), ((0.6, 0.5, 0.5), 1), ((0.5, 0.1, 0.1), 0)])
def test_ordinal_class(spark, probabilities, cls):
    assert one(spark, c=occupancy.ordinal_class(*[F.lit(p) for p in probabilities]))["c"] == cls


@pytest.mark.parametrize("value, band", [(0.0, 0), (0.19, 0), (0.2, 1), (0.79, 3), (1.0, 4), (1.2, None), (-0.1, None)])
def test_intensity_band(spark, value, band):
    assert one(spark, b=occupancy.intensity_band(F.lit(value)))["b"] == band


def test_unknown_class_takes_first_color(spark):
    row = one(spark, a=occupancy.class_color(F.lit(9)), b=occupancy.class_color(F.lit(6)))
    assert (row["a"], row["b"]) == ("#22c55e", "#6b7280")


def test_occupancy_dim_has_seven_rows(spark):
    rows = occupancy.occupancy_dim(spark).collect()
    assert [r["class"] for r in rows] == list(range(7)) and rows[3]["long_label"] == "Standing room only"


@pytest.mark.parametrize("short, long_name, label", [("4", "Centre", "4 - Centre"), ("4", None, "Route: 4"), ("", "Centre", "Route: Centre"), (None, None, None)])
def test_route_label(spark, short, long_name, label):
    args = [F.lit(v).cast("string") for v in (short, long_name)]
    assert one(spark, l=occupancy.route_label(*args))["l"] == label


def test_conditions_text(spark):
    at = F.lit("2024-01-01 08:00:00").cast("timestamp")
    text = occupancy.conditions_text(F.lit(-2.5), F.lit(1.0), F.lit(0.0), F.lit("Regular day"), at)
    bare = occupancy.conditions_text(F.lit(None).cast("double"), F.lit(0.0), F.lit(None).cast("double"), F.lit("Holiday"), at)
    row = one(spark, a=text, b=bare)
    assert (row["a"], row["b"]) == ("-2°C | Snow | Regular day | Monday", "Holiday | Monday")


@pytest.mark.parametrize("text, number", [("123", 123), ("", 0), ("x", 0), (None, 0), (" 7 ", 7)])
def test_id_to_int(spark, text, number):
    assert one(spark, i=values.id_to_int(F.lit(text).cast("string")))["i"] == number


@pytest.mark.parametrize("text, clean", [("a", "a"), ("  ", None), ("nan", None), ("None", None), (None, None)])
def test_blank_to_null(spark, text, clean):
    assert one(spark, v=values.blank_to_null(F.lit(text).cast("string")))["v"] == clean


def test_falsy_and_null_defaults(spark):
    row = one(
        spark, a=values.falsy_to_default(F.lit(0.0), 10.0), b=values.null_to_default(F.lit(0.0), 10.0),
        c=values.falsy_to_default(F.lit(None).cast("double"), 10.0),
    )
    assert (row["a"], row["b"], row["c"]) == (10.0, 0.0, 10.0)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 200_000))
def test_clock_round_trip(spark, seconds):
    assert one(spark, s=clock.clock_seconds(clock.clock_text(F.lit(seconds))))["s"] == seconds
