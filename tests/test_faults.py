"""Inputs that once gave wrong results: infinities, mixed headers, bad lines, folders of part files, a second daily run."""

import math
import os

import pytest
from pyspark.sql import functions as F

from headway.operators import ranks
from headway.plans import features
from headway.session import scratch_path
from headway.sources import feeds, timetable
from headway.sources.tables import CATALOG, TableStore
from headway.suite import QUERIES
from headway.suite.standins import SCHEMAS, StandIns

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("limit", [64, 2048])
def test_ranks_with_infinite_and_huge_values(spark, monkeypatch, limit):
    monkeypatch.setattr(ranks, "BINS", limit)
    values = [math.inf, -math.inf, math.inf, 1.7e308, -1.7e308, 0.0, 5.0, 7.0, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    hits = ranks.locate_ranks(df, {"x": list(range(9))})["x"]
    assert [h and h.value for h in hits] == [-math.inf, -1.7e308, 0.0, 5.0, 7.0, 1.7e308, math.inf, math.inf, None]
    assert [h.below for h in hits[:8]] == [0, 1, 2, 3, 4, 5, 6, 6]


def test_timetable_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "stops.txt"
    folder.mkdir()
    (folder / "a.csv").write_text("stop_id,stop_name,stop_lat,stop_lon\n1,One,58.1,15.1\n")
    (folder / "b.csv").write_text("stop_lon,zone,stop_lat,stop_name,stop_id\n15.2,z,58.2,Two,2\n")
    (folder / "c.csv").write_text("stop_id,stop_name\n3,Three\n")
    rows = timetable.read_table(spark, f"file://{tmp_path}", "stops").orderBy("stop_id").collect()
    assert [tuple(r) for r in rows] == [("1", "One", 58.1, 15.1), ("2", "Two", 58.2, 15.2), ("3", "Three", None, None)]


def test_bad_lines_are_kept_and_counted(spark, tmp_path):
    part = tmp_path / "date=2024-01-01" / "hour=3"
    part.mkdir(parents=True)
    good = '{"entity":[{"id":"a","vehicle":{"timestamp":5}}]}'
    (part / "x.json").write_text("\n".join([good, good[:-4], good.replace("5", '"soon"')]) + "\n")
    messages = feeds.read_feed_messages(spark, f"file://{tmp_path}")
    assert [(r.n_lines, r.n_bad) for r in feeds.bad_records(messages).collect()] == [(3, 2)]
    assert "a" in [r.feed_entity_id for r in feeds.flatten_positions(messages).collect()]


def test_streams_read_folders_of_part_files(spark, tmp_path):
    events = spark.read.schema(SCHEMAS["events"]).parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(f"file://{tmp_path}/events.parquet")
    assert len(os.listdir(tmp_path / "events.parquet")) > 3
    assert QUERIES["stream_window_1min"](spark, f"file://{tmp_path}").count() == QUERIES["stream_window_1min"](spark, SF).count() > 0


def test_second_day_leaves_the_files_of_the_first(spark):
    t, path = StandIns(spark, SF), scratch_path(spark, "days")
    store, day = TableStore(spark, path), F.to_date("timestamp")
    run = lambda d: features.run_day(store, t.pings.filter(day == F.lit(d).cast("date")), t.day_incidents, t.weather, t.holidays)
    run("2024-01-05")
    spec = CATALOG["combined_features_daily"]
    files = lambda: {f for f in store._runs(spec).filter("date = '2024-01-05'").inputFiles() if "date=2024-01-05" in f}
    before = files()
    second = run("2024-01-06")
    assert {str(r[0]) for r in second.select("date").distinct().collect()} == {"2024-01-06"}
    assert files() == before


def test_combined_features_meet_incidents(spark):
    rows = QUERIES["combined_features"](spark, SF)
    assert rows.filter("has_nearby_event = 1 AND affected_roads IS NOT NULL").count() > 0
    assert set(rows.columns) == {f.name for f in features.COMBINED_SCHEMA.fields}


def test_named_trips_are_misfits_among_numbers(spark):
    found = QUERIES["conform_misfits"](spark, SF).first()
    assert found.trip_id == spark.read.parquet(f"{SF}/events.parquet").count() > 0
    assert (found.vehicle_id, found.speed, found.absent) == (0, 0, 0)


def test_numbered_trips_are_cast_as_well_as_named_ones(spark):
    t = StandIns(spark, SF)
    trips = t.named_pings.select("feed_entity_id", "trip_number").exceptAll(t.pings.select("feed_entity_id", "trip_id"))
    assert trips.isEmpty() and t.named_pings.filter("trip_number IS NULL").isEmpty()
    assert QUERIES["conform_misfits"](spark, SF).first().trip_number == 0
