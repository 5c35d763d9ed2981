import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import cleaning, enrich
from headway.operators.products import map_to_slots, slots_to_map
from headway.session import prepare, scratch_path, shared_dir, written
from headway.sources import feeds, timetable
from headway.sources.tables import CATALOG, TableStore

WEATHER_JSON = '{"latitude":58.4,"longitude":15.6,"hourly":{"time":["2025-12-24T23:00","2025-12-25T00:00"],"temperature_2m":[1.5,null],"weather_code":[3,71]}}'


def test_weather_response(spark):
    df = spark.createDataFrame([(WEATHER_JSON,), ('{"latitude":1,"longitude":1,"hourly":{}}',), ("{}",)], "j string")
    rows = feeds.unpivot_weather(feeds.parse_weather(df, "j")).orderBy("timestamp").collect()
    assert [(r["date"], r["hour"], r["temperature_2m"], r["weather_code"], r["rain"]) for r in rows] == [
        (dt.date(2025, 12, 24), 23, 1.5, 3, None), (dt.date(2025, 12, 25), 0, None, 71, None)
    ]
    first = feeds.unpivot_weather(feeds.parse_weather(df, "j")).select(F.date_format("timestamp", "yyyy-MM-dd HH").alias("t"))
    assert {r["t"] for r in first.collect()} == {"2025-12-24 22", "2025-12-24 23"}


def test_holiday_response(spark):
    text = '{"dagar":[{"datum":"2025-12-25","veckodag":"Torsdag","vecka":"52","dag i vecka":"4","arbetsfri dag":"Ja","röd dag":"Ja","helgdag":"Juldagen"},{"datum":"2025-12-29","arbetsfri dag":"Nej"}]}'
    rows = feeds.flatten_holidays(feeds.parse_holidays(spark.createDataFrame([(text,), ("{}",)], "j string"), "j")).orderBy("date").collect()
    assert (rows[0]["date"], rows[0]["week"], rows[0]["day_of_week"], rows[0]["is_red_day"], rows[0]["holiday_name"]) == (dt.date(2025, 12, 25), 52, 4, True, "Juldagen")
    assert (rows[1]["is_work_free"], rows[1]["is_day_before_holiday"], rows[1]["week"], rows[1]["holiday_name"]) == (False, False, 0, None)


XML = """<RESPONSE><RESULT>
<Situation><Id>1</Id><Deleted>true</Deleted>
 <Deviation><Id>a</Id><StartTime>2025-12-01T10:00:00Z</StartTime><Geometry><WGS84>POINT (9 9)</WGS84><Line><WGS84>LINESTRING (15.1 58.1, 15.3 58.5)</WGS84></Line></Geometry></Deviation>
 <Deviation><Id>b</Id><StartTime>soon</StartTime><ValidUntilFurtherNotice>true</ValidUntilFurtherNotice></Deviation></Situation>
<Situation><Id>2</Id></Situation></RESULT></RESPONSE>"""


def test_situation_file(spark, tmp_path):
    (tmp_path / "pull.xml").write_text(XML)
    flat = feeds.flatten_incidents(feeds.read_situations(spark, f"file://{tmp_path}"), "2025-12-02")
    rows = {r["deviation_id"]: r for r in flat.collect()}
    assert set(rows) == {"a", "b", None} and rows[None]["event_id"] == "2"
    # the line wins over the plain geometry
    assert (rows["a"]["latitude"], rows["a"]["longitude"]) == (pytest.approx(58.3), pytest.approx(15.2))
    assert rows["a"]["deleted"] and rows["b"]["valid_until_further_notice"] and not rows["a"]["valid_until_further_notice"]
    typed = feeds.typed_incidents(flat).collect()
    assert [r["deviation_id"] for r in typed] == ["a"]
    assert typed[0]["end_time"] - typed[0]["start_time"] == dt.timedelta(days=1)
    assert feeds.typed_incidents(flat, drop_deleted=True).isEmpty()


def test_situation_texts_of_one_task_are_dealt_to_all(spark):
    texts = spark.range(40).select(F.format_string("<Situation><Id>%d</Id></Situation>", "id").alias("x"), F.lit("other").alias("rest")).coalesce(1)
    parsed = feeds.parse_situations(texts, "x")
    assert sorted(int(r["Id"]) for r in parsed.collect()) == list(range(40))
    assert parsed.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_situation_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "FILE_SITUATIONS", 3)
    texts = spark.range(10).select(F.format_string("<Situation><Id>%d</Id></Situation>", "id").alias("x"))
    feeds.write_situations(feeds.parse_situations(texts, "x").coalesce(1), f"file://{tmp_path}/s")
    files = list((tmp_path / "s").glob("part-*"))
    assert len(files) == 4 and all(f.read_text().count("<Situation>") <= 3 for f in files)
    assert sorted(int(r["Id"]) for r in feeds.read_situations(spark, f"file://{tmp_path}/s").collect()) == list(range(10))


def test_open_ended_incidents(spark):
    df = spark.sql("select timestamp'2025-12-01 10:00:00' start_time, cast(null as timestamp) end_time, true valid_until_further_notice")
    assert cleaning.default_end_time(df).first()["end_time"] == dt.datetime(2025, 12, 2, 10)
    assert cleaning.default_end_time(df, "forever").first()["end_time"].year == 9999


def test_positions_from_files(spark, tmp_path):
    folder = tmp_path / "date=2025-12-01" / "hour=7"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(
        '{"entity":[{"id":"1","vehicle":{"trip":{"trip_id":"t"},"vehicle":{"id":""},"position":{"latitude":58.0},"timestamp":0}},{"id":"2"}]}\n'
        "not json\n"
        '{"entity":[{"id":"3","vehicle":{"trip":{"trip_id":"t"},"vehicle":{"id":"v"},"timestamp":1764572400,"occupancy_status":2}}]}\n'
    )
    rows = {r["feed_entity_id"]: r for r in feeds.flatten_positions(feeds.read_feed_messages(spark, f"file://{tmp_path}")).collect()}
    assert set(rows) == {"1", "3"}
    assert (rows["1"]["timestamp"], rows["1"]["vehicle_id"], rows["1"]["occupancy_status"], rows["1"]["hour"]) == (None, None, None, 7)
    assert (rows["3"]["occupancy_status"], rows["3"]["timestamp"]) == (2, dt.datetime(2025, 12, 1, 7, 0))


def test_hour_coverage(spark):
    df = spark.createDataFrame([("d", h) for h in (0, 0, 5, 99)], "date string, hour int")
    row = feeds.hour_coverage(df).first()
    assert (row["hours_with_data"], row["empty_hours"]) == (2, 22) and row["missing_hours"].startswith("1,2,3,4,6,")


def test_timetable_follows_header(spark, tmp_path):
    (tmp_path / "calendar_dates.txt").write_text("exception_type,extra,date,service_id\n2,x,20251224,s1\nbad,x,nope,s2\n")
    rows = {r["service_id"]: r for r in timetable.read_table(spark, f"file://{tmp_path}", "calendar_dates").collect()}
    assert (rows["s1"]["date"], rows["s1"]["exception_type"]) == (dt.date(2025, 12, 24), 2)
    assert (rows["s2"]["date"], rows["s2"]["exception_type"]) == (None, None)


def test_shapes_are_ordered(spark):
    df = spark.createDataFrame([("b", "2", "58", "15", "x"), ("a", "10", "58", "15", "1.5"), ("a", "9", "58", "15", "")], timetable.SCHEMAS["shapes"])
    rows = [(r["shape_id"], r["shape_pt_sequence"], r["shape_dist_traveled"]) for r in timetable.normalise_shapes(df).collect()]
    assert rows == [("a", 9, None), ("a", 10, 1.5), ("b", 2, None)]


def test_service_calendar(spark):
    calendar = spark.sql("select 'A' service_id, 1 monday, 1 tuesday, 0 wednesday, 0 thursday, 0 friday, 0 saturday, 0 sunday, date'2024-01-01' start_date, date'2024-01-05' end_date")
    exceptions = spark.sql("select 'A' service_id, date'2024-01-02' date, 2 exception_type union all select 'B', date'2024-01-03', 1 union all select 'C', date'2024-01-03', 1 union all select 'C', date'2024-01-03', 2")
    got = {(r["service_id"], r["date"].day) for r in cal.service_calendar(calendar, exceptions).collect()}
    assert got == {("A", 1), ("B", 3)}


def test_many_to_one_guard(spark):
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(enrich.NotManyToOne):
        enrich.many_to_one(right.select("k"), right, ["k"])
    assert enrich.many_to_one(right.select("k"), right.limit(1), ["k"]).count() == 2


def test_stops_of_a_trip_move_once_for_duplicates_and_trips(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fact = spark.createDataFrame([("t", "s", 1, "10:00:00")] * 2 + [("t", "s", 2, "11:00:00")], "trip_id string, stop_id string, stop_sequence int, arrival_time string")
        dim = spark.createDataFrame([("t", "x")], "trip_id string, route_id string")
        wide = enrich.trip_stops_enriched(fact, dim, "2024-01-01", ["arrival_time"])
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r["stop_sequence"], r["route_id"]) for r in wide.collect()) == [(1, "x"), (2, "x")]
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan


def windows_frame(spark):
    return spark.sql("select 't' trip_id, timestamp'2024-01-06 10:30:00' window_start, date'2024-01-06' date")


def test_weather_join_uses_one_row_per_hour(spark):
    weather = spark.sql("""select timestamp'2024-01-06 10:00:00' timestamp, 58.5D latitude, 15D longitude, 9D temperature_2m
        union all select timestamp'2024-01-06 10:00:00', 58.0D, 15D, 4D""")
    rows = enrich.join_weather(windows_frame(spark), weather).collect()
    assert [r["temperature_2m"] for r in rows] == [4.0]


def test_holiday_join_defaults_to_false(spark):
    holidays = spark.sql("select date'2024-01-07' date, true is_work_free, true is_red_day, false is_day_before_holiday, 'x' holiday_name")
    row = enrich.attach_day_constants(windows_frame(spark), holidays).first()
    assert (row["is_work_free"], row["is_red_day"], row["is_holiday"]) == (False, False, False)


def test_weekend_rule_for_missing_holidays(spark):
    none = spark.sql("select date'2024-01-08' date, true is_work_free, true is_red_day, true is_day_before_holiday where false")
    row = enrich.join_holidays(windows_frame(spark), none, weekend=True).first()
    # a Saturday
    assert (row["is_work_free"], row["is_red_day"], row["is_day_before_holiday"]) == (True, False, False)


def test_nearest_hour_prefers_earlier_and_reaches_other_days(spark):
    weather = spark.sql("select timestamp'2024-01-01 00:00:00' timestamp, 1D temperature_2m union all select timestamp'2024-01-03 00:00:00', 3D")
    targets = spark.sql("""select 1 id, timestamp'2024-01-02 00:40:00' target_time union all select 2, timestamp'2024-01-02 01:00:00'
        union all select 3, timestamp'2023-06-01 00:00:00' union all select 4, timestamp'2024-09-01 00:00:00'""")
    got = {r["id"]: r["temperature_2m"] for r in enrich.nearest_hour(targets, weather).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 1.0, 4: 3.0}


def test_upsert_is_idempotent_and_newest_wins(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["forecast_fg"]

    def batch(rows):
        return spark.createDataFrame(rows, "trip_id string, hour int, weekday int, predicted_occupancy int, generated_at timestamp")

    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert store.read(spec) is None
    store.upsert(spec, batch([("a", 8, 1, 0, new), ("b", 8, 2, 0, old), ("b", 8, 2, 1, new)]))
    late = batch([("a", 8, 1, 5, old), ("c", 9, 1, 2, old)])
    store.upsert(spec, late)
    store.upsert(spec, late)
    store.upsert(spec, batch([("c", 9, 1, 3, old)]))
    got = {(r["trip_id"], r["predicted_occupancy"]) for r in store.read(spec).collect()}
    # equal event time: the later batch wins
    assert got == {("a", 0), ("b", 1), ("c", 3)}


def test_upsert_gate_and_untouched_partitions(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    one = spark.sql("select 'a' trip_id, timestamp'2024-01-01 10:00:00' window_start, 1 n")
    store.upsert(spec, one)
    store.upsert(spec, one.withColumn("window_start", F.expr("window_start + interval 1 day")))
    assert store.read(spec).count() == 2
    with pytest.raises(ValueError):
        store.upsert(spec, one.withColumn("trip_id", F.lit(None).cast("string")))
    days = {(r["date"].day, r["n_rows"]) for r in store.rows_per_day(spec, "window_start", "2024-01-09").collect()}
    assert days == {(1, 1), (2, 1), (9, 0)}
    plan = store.read(spec).filter("date = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_run_that_stops_before_it_appears_keeps_the_old_rows(spark, monkeypatch):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    row = spark.sql("select 'a' trip_id, timestamp'2024-01-01 10:00:00' window_start, 1 n")
    store.upsert(spec, row)
    newer = row.unionAll(spark.sql("select 'b', timestamp'2024-01-01 11:00:00', 2"))
    with monkeypatch.context() as broken:
        broken.setattr(TableStore, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.upsert(spec, newer)
    assert [(r["trip_id"], r["n"]) for r in store.read(spec).collect()] == [("a", 1)]
    store.upsert(spec, newer)
    assert sorted((r["trip_id"], r["n"]) for r in store.read(spec).collect()) == [("a", 1), ("b", 2)]


def test_compaction_keeps_the_newest_rows(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    rows = spark.sql("select concat('t', id % 7) trip_id, timestampadd(HOUR, id % 60, timestamp'2024-01-01 10:00:00') window_start, id n from range(420)")
    store.compact(spec)  # nothing there yet
    for part in range(4):
        store.upsert(spec, rows.filter(F.col("n") % 3 != part).withColumn("n", F.col("n") + 1000 * part))
    before = sorted(map(tuple, store.read(spec).select("trip_id", "window_start", "n").collect()))
    store.compact(spec)
    assert store._runs(spec).select("run").distinct().count() == 1 and store._runs(spec).count() == len(before) == 420
    assert sorted(map(tuple, store.read(spec).select("trip_id", "window_start", "n").collect())) == before
    store.upsert(spec, rows.limit(1).withColumn("n", F.lit(-1).cast("bigint")))
    assert store.read(spec).filter("n = -1").count() == 1


def test_a_named_run_replaces_itself_and_may_bring_columns(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    row = spark.sql("select 'a' trip_id, timestamp'2024-01-01 10:00:00' window_start, 1 n")
    store.upsert(spec, row, run=7)
    store.upsert(spec, row.withColumn("n", F.lit(2)), run=7)
    store.upsert(spec, row.withColumns({"trip_id": F.lit("b"), "more": F.lit(5)}), run=9)
    assert sorted((r["trip_id"], r["n"], r["more"]) for r in store.read(spec).collect()) == [("a", 2, None), ("b", 1, 5)]
    assert [str(r[0]) for r in store.touched(spec, 9).collect()] == ["2024-01-01"]


def test_gate_counts_in_the_pass_that_writes(spark):
    """A batch is evaluated once: the gate needs no scan of its own."""
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.sql("select if(id = 3, null, 'a') trip_id, timestampadd(HOUR, id, timestamp'2024-01-01 10:00:00') window_start from range(10)")
    rows = rows.coalesce(1).mapInArrow(counted, rows.schema)
    with pytest.raises(ValueError, match="trip_id': 1"):
        store.upsert(spec, rows)
    assert store.read(spec) is None and seen.value == 10
    store.upsert(spec, rows.filter("trip_id is not null"))
    assert store.read(spec).count() == 9 and seen.value == 20


def test_a_clustered_read_moves_its_rows_once(spark):
    store, spec = TableStore(spark, scratch_path(spark, "tables")), CATALOG["forecast_fg"]
    rows = spark.range(6).select(
        (F.col("id") % 2).cast("string").alias("trip_id"), F.col("id").alias("hour"), F.lit(1).alias("weekday"),
        F.lit("2024-01-01").cast("timestamp").alias("generated_at"), F.col("id").alias("n"),
    )
    store.upsert(spec, rows, run=1, distinct=True)
    store.upsert(spec, rows.withColumn("n", F.col("n") + 10).filter("n > 12"), run=2)
    read = store.read(spec)
    assert sorted(r["n"] for r in read.collect()) == [0, 1, 2, 13, 14, 15]
    moved = read.groupBy("trip_id").count()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(trip_id#\d+, \d+\)", moved)) == moved.count("Exchange ") == 1


def test_odd_partition_values(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["static_trip_info_fg"]
    rows = spark.sql("select * from values ('a', 'x=1/2 %', 1), ('b', null, 2), ('c', '2024-01-01', 3) t(trip_id, feed_date, n)")
    store.upsert(spec, rows)
    store.upsert(spec, rows.filter("n <> 3").withColumn("n", F.col("n") + 10))
    assert sorted(r["n"] for r in store.read(spec).collect()) == [3, 11, 12]


def test_rows_per_day_counts_only_the_days_it_returns(spark):
    store, spec = TableStore(spark, scratch_path(spark, "t")), CATALOG["vehicle_trip_agg_fg"]
    days = spark.sql("select 'a' trip_id, timestampadd(DAY, id, timestamp'2024-01-01 10:00:00') window_start from range(9)")
    store.upsert(spec, days)
    counted = store.rows_per_day(spec, "window_start", last=2)
    assert sorted((r["date"].day, r["n_rows"]) for r in counted.collect()) == [(8, 1), (9, 1)]
    scan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "ReadSchema: struct<trip_id:string,window_start:timestamp>" in scan  # the key alone


def test_slot_map_round_trip(spark):
    df = spark.createDataFrame([(5, 0, '{"type":"FeatureCollection"}'), (23, 6, "x")], "hour int, weekday int, geojson string")
    assert {tuple(r) for r in map_to_slots(slots_to_map(df)).collect()} == {tuple(r) for r in df.collect()}


def test_column_names():
    assert [cleaning.snake_name(n) for n in (" Trip ID ", "_x", "2nd Name", "ok")] == ["trip_id", "f_x", "f_2nd_name", "ok"]


def test_duplicate_columns_keep_the_first(spark):
    df = spark.sql("select 1 a, 2 b, 3 a")
    out = cleaning.dedup_columns(df)
    assert out.columns == ["a", "b"] and tuple(out.first()) == (1, 2)


def test_bad_ids_are_dropped_in_the_other_variant(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("3", "")], "trip_id string, vehicle_id string")
    assert [tuple(r) for r in cleaning.ids_to_int(df, drop_bad=True).collect()] == [(1, 2)]


def test_written_and_scratch_use_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    df = written(spark.sql("select 1 a, array(2) b"), "x")
    assert df.collect()[0]["b"] == [2] and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_prepare_pins_utc(spark):
    assert prepare(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_scan_reads_only_what_the_query_needs(spark):
    from headway.suite import QUERIES

    plan = QUERIES["table_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp>" in plan


def test_unreadable_timetable_values_are_counted(spark, tmp_path):
    folder = tmp_path / "calendar_dates.txt"
    folder.mkdir()
    (folder / "a.txt").write_text("service_id,date,exception_type\ns,20240101,1\ns,2024-13-01,one\ns,,\n")
    (folder / "b.txt").write_text("exception_type,service_id\n2x,s\n2,s\n")
    assert timetable.unreadable(spark, str(tmp_path), "calendar_dates").first().asDict() == {"n_rows": 5, "exception_type": 2, "date": 1}
    assert timetable.read_table(spark, str(tmp_path), "calendar_dates").filter("exception_type IS NULL").count() == 3
