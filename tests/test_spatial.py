import datetime as dt
import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway import session
from headway.operators import matching, spatial

INCIDENT = "event_id string, deviation_id string, start_time timestamp, end_time timestamp, latitude double, longitude double, severity_code string, affected_road string"
T0 = dt.datetime(2025, 12, 1, 10, 0)


def metres(a, b, c, d, r=6_371_008.8):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * r * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def windows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, window_start timestamp, lat_mean double, lon_mean double")


def incidents(spark, rows):
    return spark.createDataFrame(rows, INCIDENT)


@pytest.mark.parametrize("base", [(58.41, 15.62), (0.0, 0.0), (-33.9, 151.2), (69.9, 20.0), (58.0, -0.0005)])
@pytest.mark.parametrize("radius", [50.0, 500.0, 4000.0])
def test_radius_join_equals_brute_force(spark, base, radius):
    """Points around one spot, a third of them in the same place."""
    import random

    dice = random.Random(3)
    reach = math.degrees(radius / 6_371_000) * 3

    def place(i):
        if i % 3 == 0:
            return base
        return base[0] + dice.uniform(-reach, reach), base[1] + dice.uniform(-reach, reach) * 2

    points = [(i, *place(i)) for i in range(150)]
    targets = [(i, *place(i)) for i in range(60)] + [(999, None, 15.0)]
    p = spark.createDataFrame(points, "pid int, plat double, plon double")
    t = spark.createDataFrame(targets, "tid int, tlat double, tlon double")
    got = {(r["pid"], r["tid"]) for r in spatial.radius_pairs(p, t, radius, ("plat", "plon"), ("tlat", "tlon")).collect()}
    want = {
        (a, x) for a, b, c in points for x, y, z in targets[:-1] if metres(b, c, y, z, 6_371_000.0) <= radius
    }
    assert got == want and got


def test_pairs_are_unique(spark):
    p = spark.range(50).select(F.col("id").alias("pid"), F.lit(58.0).alias("plat"), F.lit(15.0).alias("plon"))
    t = p.toDF("tid", "tlat", "tlon")
    assert spatial.radius_pairs(p, t, 500.0, ("plat", "plon"), ("tlat", "tlon")).count() == 2500


def test_incident_bounds_are_inclusive(spark):
    w = windows(spark, [("a", T0, 58.4108, 15.6214)])
    near, far = (58.4148, 15.6253), (58.4158, 15.6253)
    rows = [
        ("start", "1", T0, T0 + dt.timedelta(days=40), *near, "2", "E4"),
        ("end", "1", T0 - dt.timedelta(days=30), T0, *near, "10", "E22"),
        ("past", "1", T0 - dt.timedelta(days=30), T0 - dt.timedelta(seconds=1), *near, "3", "E4"),
        ("far", "1", T0, T0, *far, "3", "E4"),
        ("nowhere", "1", T0, T0, None, None, "3", "E4"),
    ]
    got = {r["event_id"] for r in spatial.incident_pairs(w, incidents(spark, rows)).collect()}
    assert got == {"start", "end"}
    feature = spatial.incident_features(w, incidents(spark, rows)).first()
    # numeric maximum, roads in order of the earliest incident
    assert feature["nearby_event_severity"] == 10.0 and feature["affected_roads"] == "E22,E4"
    assert (feature["num_nearby_traffic_events"], feature["has_nearby_event"]) == (2, 1)


def test_matches_equal_the_summary_of_pairs_in_every_division(spark, monkeypatch):
    """Blocks of a few rows, tiles of a few windows, repeated and null keys, radii whose bound falls on a distance."""
    w = spark.range(600).selectExpr(
        "CASE WHEN id % 37 > 0 THEN 't' || id % 450 END AS trip_id", "timestamp_seconds(1704067200 + id % 450 * 4001) AS window_start",
        "CASE WHEN id % 41 > 0 THEN 58.4 + id * 7 % 50 / 5000 END AS lat_mean", "double(15.6 + id * 11 % 50 / 2500) AS lon_mean",
    )
    i = spark.range(300).selectExpr(
        "'e' || id % 250 AS event_id", "'d' || id % 7 AS deviation_id", "timestamp_seconds(1704067200 + id * 4001) AS start_time",
        "timestamp_seconds(1704067200 + id * 4001 + id % 9 * 90000 - 4001) AS end_time", "58.4 + id * 7 % 50 / 5000 AS latitude", "15.6 + id * 13 % 50 / 2500 AS longitude",
        "CASE id % 4 WHEN 0 THEN 'x' WHEN 1 THEN NULL ELSE string(id % 12) END AS severity_code",
        "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'E' || id % 11 END AS affected_road",
    ).withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})
    w = w.withColumn("lat_mean", F.col("lat_mean").cast("double"))
    for radius in (500.0, 0.5):
        want = spatial.incident_summary(spatial.incident_pairs(w, i, radius), ["trip_id", "window_start"]).collect()
        assert want
        for blocks, tile in ((10_000, 256), (7, 3)):
            monkeypatch.setattr(spatial, "BLOCK_WINDOWS", blocks)
            monkeypatch.setattr(spatial, "BLOCK_INCIDENTS", blocks)
            assert sorted(map(str, spatial.incident_matches(w, i, radius).collect())) == sorted(map(str, want))


def test_tiles_and_batches_cut_meetings_anywhere():
    """The task function gives the same sums for any batches and tiles."""
    n = 400
    kind = [0] * 150 + [1] * 250
    rows = pa.table({
        **{c: pa.array([k % 1 for k in range(n)], pa.int64()) for c in matching.MEETING}, "_kind": pa.array(kind, pa.int32()),
        "_lat": [58.4 + k * 7 % 50 / 5000 for k in range(n)], "_lon": [15.6 + k * 11 % 50 / 2500 for k in range(n)],
        "_t0": [k * 10 if not x else (k - 150) * 8 for k, x in enumerate(kind)], "_t1": [k * 10 + k % 9 * 100 for k in range(n)],
        "_severity": [k % 5 for k in range(n)], "trip_id": [f"t{k}" for k in range(n)], "event_id": [f"e{k}" for k in range(n)],
        "deviation_id": ["d"] * n, "affected_road": [None if k % 5 == 0 else f"E{k % 11}" for k in range(n)],
    })

    def sums(size, tile, windows, slots):
        with pytest.MonkeyPatch.context() as m:
            for name, value in (("TILE", tile), ("TILE_WINDOWS", windows), ("TILE_SLOTS", slots)):
                m.setattr(matching, name, value)
            return [r for b in matching.matches(500.0)(iter(rows.to_batches(max_chunksize=size))) for r in b.to_pylist()]

    whole = sums(10_000, 262_144, 256, 1 << 22)
    assert whole and any(len(r["_roads"]) > 1 for r in whole)
    assert sums(7, 50, 3, 5) == whole == sums(149, 11, 256, 1 << 22)


def test_incident_features_make_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "incident_pairs", None)
    w = windows(spark, [("t", T0, 58.4, 15.6)])
    got = spatial.incident_features(w, incidents(spark, [("x", "1", T0, T0, 58.4, 15.6, "1", "E4")])).first()
    assert got["num_nearby_traffic_events"] == 1 and got["affected_roads"] == "E4"


def test_open_ended_incidents_are_cut_to_the_windows(spark):
    w = windows(spark, [("a", T0, 58.4, 15.6), ("b", T0 + dt.timedelta(days=900), 58.4, 15.6)])
    rows = [
        ("forever", "1", T0 - dt.timedelta(days=2000), dt.datetime(9999, 12, 31), 58.4, 15.6, "1", "E4"),
        ("over", "1", T0 - dt.timedelta(days=2000), T0 - dt.timedelta(days=1), 58.4, 15.6, "1", "E4"),
    ]
    got = [(r["trip_id"], r["event_id"]) for r in spatial.incident_pairs(w, incidents(spark, rows)).collect()]
    assert sorted(got) == [("a", "forever"), ("b", "forever")]


def test_windows_without_match_or_place_keep_zeros(spark):
    w = windows(spark, [("a", T0, 58.4, 15.6), ("b", T0, None, None)])
    rows = [("x", "1", T0, T0, 10.0, 10.0, "1", "E4")]
    got = spatial.incident_features(w, incidents(spark, rows)).collect()
    assert len(got) == 2
    assert {(r["num_nearby_traffic_events"], r["has_nearby_event"], r["nearby_event_severity"], r["affected_roads"]) for r in got} == {(0, 0, None, None)}


def test_unknown_severity_and_road(spark):
    w = windows(spark, [("a", T0, 58.4, 15.6)])
    rows = [(str(i), "1", T0, T0, 58.4, 15.6, None, None) for i in range(3)]
    got = spatial.incident_features(w, incidents(spark, rows)).first()
    assert (got["num_nearby_traffic_events"], got["nearby_event_severity"], got["affected_roads"]) == (3, None, None)


STOP = "trip_id string, stop_id string, stop_sequence int, arrival_time string, stop_name string, stop_headsign string, stop_lat double, stop_lon double"


def nearest(spark, stops, at=dt.datetime(2024, 1, 1, 8, 30)):
    requests = spark.createDataFrame([(1, 58.41, 15.62, at)], "request_id int, lat double, lon double, at timestamp")
    row = spatial.nearest_trip(requests, spark.createDataFrame(stops, STOP)).first()
    return row and (row["trip_id"], row["closest_stop"])


def stop(trip, seq, arrival, metres_north, name):
    return (trip, name, seq, arrival, name, "h", 58.41 + math.degrees(metres_north / 6_371_000), 15.62)


def test_nearest_trip_tiers(spark):
    inside_late, inside_timely = stop("a", 1, "12:00:00", 100, "late"), stop("b", 1, "09:00:00", 400, "timely")
    outer = stop("c", 1, "08:30:00", 900, "outer")
    assert nearest(spark, [inside_late, inside_timely, outer]) == ("b", "timely")
    assert nearest(spark, [inside_late, outer]) == ("a", "late")
    assert nearest(spark, [outer, stop("d", 1, "12:00:00", 600, "late")]) == ("c", "outer")
    assert nearest(spark, [stop("d", 1, "12:00:00", 600, "late")]) == ("d", "late")
    assert nearest(spark, [stop("d", 1, "08:30:00", 1100, "far")]) is None


def test_nearest_trip_ties(spark):
    same = [stop("z", 1, "08:40:00", 50, "s"), stop("b", 9, "08:31:00", 50, "s"), stop("a", 2, "08:31:00", 50, "s"), stop("c", 1, "bad", 50, "s")]
    assert nearest(spark, same) == ("a", "s")
    assert nearest(spark, [stop("c", 1, "bad", 50, "s"), stop("b", 1, None, 50, "s")]) == ("b", "s")


@pytest.mark.parametrize("arrival", ["07:30:00", "09:30:00"])
def test_nearest_trip_hour_is_inclusive(spark, arrival):
    assert nearest(spark, [stop("a", 1, arrival, 400, "edge"), stop("b", 1, "12:00:00", 10, "late")]) == ("a", "edge")


def test_nearest_trip_equals_brute_force_at_busy_terminal(spark):
    """All stops in two places, many visits per minute, targets on full minutes."""
    import random

    dice = random.Random(5)
    stops = []
    for i in range(400):
        s = dice.randrange(0, 90_000)
        stops.append(stop(f"t{i:03d}", i % 9, f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", 100 if i % 3 else 700, "hub" if i % 3 else "side"))
    times = [dt.datetime(2024, 1, 1, h, m) for h in (0, 5, 12, 23) for m in (0, 1, 30, 59)]
    requests = spark.createDataFrame([(i, 58.41, 15.62, t) for i, t in enumerate(times)], "request_id int, lat double, lon double, at timestamp")
    got = {r["request_id"]: r["trip_id"] for r in spatial.nearest_trip(requests, spark.createDataFrame(stops, STOP)).collect()}
    for i, t in enumerate(times):
        target = t.hour * 3600 + t.minute * 60

        def order(s):
            h, m, x = map(int, s[3].split(":"))
            gap, d = abs(h * 3600 + m * 60 + x - target), metres(58.41, 15.62, s[6], s[7])
            return ((0 if d <= 500 else 2) + (0 if gap <= 3600 else 1), round(d, 3), gap, s[0], s[2])

        assert got[i] == min(stops, key=order)[0]


def test_nearest_place_equals_brute_force(spark):
    """Requests with a place at hand, far off, at the edge and none within the radius; many places share a position."""
    import random

    dice = random.Random(8)
    places = [(58.0 + dice.uniform(0, 0.01), 15.0 + dice.uniform(0, 0.02)) for _ in range(80)] * 3 + [(58.5, 15.5), (None, 15.0)]
    requests = [(i, 58.0 + dice.uniform(-0.06, 0.06), 15.0 + dice.uniform(-0.1, 0.1)) for i in range(80)]
    requests += [(100, 58.5, 15.5), (101, 59.5, 15.5), (102, None, 15.0)]
    r = spark.createDataFrame(requests, "request_id int, lat double, lon double")
    p = spark.createDataFrame(places, "stop_lat double, stop_lon double")
    got = {x["request_id"]: x["distance_m"] for x in spatial.nearest_place(r, p).collect()}
    want = {}
    for i, lat, lon in requests:
        if lat is not None:
            best = min(metres(lat, lon, a, b, 6_371_000.0) for a, b in places[:-1])
            if best <= 5000:
                want[i] = pytest.approx(best, abs=1e-6)
    assert got == want and 10 < len(want) < 80


def test_closest_stop_of_trip(spark):
    stops = spark.createDataFrame([stop("a", 1, "08:00:00", 900, "x"), stop("a", 2, "08:00:00", 300, "y"), stop("b", 1, "08:00:00", 1, "z")], STOP)
    requests = spark.createDataFrame([(1, "a", 58.41, 15.62), (2, "none", 58.41, 15.62)], "request_id int, trip_id string, lat double, lon double")
    got = {r["request_id"]: r["stop_name"] for r in spatial.closest_stop(requests, stops).collect()}
    assert got == {1: "y", 2: None}


def test_radius_join_is_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = windows(spark, [("a", T0, 58.4, 15.6)])
        i = incidents(spark, [("x", "1", T0, T0, 58.4, 15.6, "1", "E4")])
        plan = spatial.incident_pairs(w, i)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_cy" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_visits_carry_no_columns_of_their_trips(spark, monkeypatch):
    from headway.suite import QUERIES

    seen = {}
    monkeypatch.setattr(spatial, "written", lambda df, name: seen.setdefault(name, session.written(df, name)))
    rows = QUERIES["nearest_trip"](spark, "/root/testdata/sf0.001")
    assert "route_short_name" in rows.columns and "trip_headsign" in rows.columns
    assert not {"route_short_name", "route_long_name", "trip_headsign"} & set(seen["visits"].schema["_first"].dataType.names)


def test_rounds_of_nearest_places_send_nothing_to_all_tasks(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.written(df, name)

    monkeypatch.setattr(spatial, "written", kept)
    requests = spark.createDataFrame([(1, 58.0, 15.0), (2, 58.02, 15.0)], "request_id long, lat double, lon double")
    found = spatial.nearest_place(requests, spark.createDataFrame([(58.0, 15.001)], "stop_lat double, stop_lon double")).collect()
    assert len(found) == 2 and len(plans) > 4
    assert any("Join" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_nearest_trip_widens_its_circle_only_for_requests_without_a_timely_place(spark, monkeypatch):
    """A request with a timely place at hand never meets the places of the whole circle; repeated and null ids share one answer."""
    met, real = [], spatial.radius_pairs
    monkeypatch.setattr(spatial, "radius_pairs", lambda points, targets, radius, *a, **b: met.append((radius, targets.count())) or real(points, targets, radius, *a, **b))
    at = dt.datetime(2024, 1, 1, 8, 30)
    stops = [stop("a", 1, "08:30:00", 20, "near"), stop("b", 1, "08:30:00", 400, "inner"), stop("c", 1, "08:30:00", 1900, "outer")]
    north = lambda m: 58.41 + math.degrees(m / 6_371_000)
    places = {1: 0, 2: 220, 3: 2700, None: 2690}
    rows = [(i, north(m), 15.62, at) for i, m in places.items()] + [(1, north(800), 15.62, at), (None, north(30), 15.62, at)]
    requests = spark.createDataFrame(rows, "request_id int, lat double, lon double, at timestamp")
    found = {r["request_id"]: (r["trip_id"], r["distance_m"]) for r in spatial.nearest_trip(requests, spark.createDataFrame(stops, STOP)).collect()}
    assert found == {1: ("a", pytest.approx(20, abs=0.1)), 2: ("b", pytest.approx(180, abs=0.1)), 3: ("c", pytest.approx(800, abs=0.1)), None: ("a", pytest.approx(10, abs=0.1))}
    assert met == [(62.5, 6), (250.0, 2), (500.0, 1), (1000.0, 1)]
