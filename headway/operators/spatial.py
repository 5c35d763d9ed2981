"""Distance joins: incidents around windows, trips and stops around points.

A radius join is an equi-join on grid cells. Every point lies in one cell; a
target is listed once in each cell its bounding box touches. Each true pair
therefore meets exactly once, and the exact distance test runs inside the
join. The cell side is about twice the radius, which gives a target about four
copies. Cells do not wrap at the date line.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.clock import clock_seconds, within_seconds
from headway.functions.geo import LOOKUP_RADIUS_M, MEAN_RADIUS_M, haversine_m, metres_rounded
from headway.operators import matching
from headway.session import written

# windows and incidents of one cell and week that one meeting holds, about; busier ones are cut into blocks
BLOCK_WINDOWS, BLOCK_INCIDENTS = 8192, 32_768
# slack on the bounding box, far above rounding error and far below a metre
_EPS_DEG = 1e-7


def cell_sides_deg(radius_m: float, sphere_m: float) -> tuple[float, float]:
    """Height and width of a cell; any constant pair is exact, this one suits 55-65 degrees north."""
    height = max(math.degrees(radius_m / sphere_m) * 2, 1e-6)
    return height, height * 2


def cell_of(ordinate, side: float) -> Column:
    return F.floor(ordinate / side)


def box_cells(lat: Column, lon: Column, radius_m: float, sphere_m: float) -> Column:
    """Array of (cy, cx) cells that a circle's bounding box touches."""
    height, width = cell_sides_deg(radius_m, sphere_m)
    dlat = math.degrees(radius_m / sphere_m) + _EPS_DEG
    # widest longitude reach of a circle on the sphere; near a pole the ratio
    # passes 1 and the circle spans every longitude
    ratio = math.sin(radius_m / sphere_m) / F.cos(F.radians(lat))
    dlon = F.when(ratio >= 1, F.lit(360.0)).otherwise(F.degrees(F.asin(ratio)) + _EPS_DEG)
    rows = F.sequence(cell_of(lat - dlat, height), cell_of(lat + dlat, height))
    columns = F.sequence(cell_of(lon - dlon, width), cell_of(lon + dlon, width))
    return F.flatten(
        F.transform(rows, lambda cy: F.transform(columns, lambda cx: F.struct(cy.alias("_cy"), cx.alias("_cx"))))
    )


def radius_pairs(
    points: DataFrame,
    targets: DataFrame,
    radius_m: float,
    point_at: tuple[str, str],
    target_at: tuple[str, str],
    sphere_m: float = LOOKUP_RADIUS_M,
    extra_keys: dict[str, tuple[Column, Column]] | None = None,
    residual: Column | None = None,
    distance: str = "distance_m",
) -> DataFrame:
    """All (point, target) pairs within the radius, bound included.

    `targets` should be the smaller side: it is the one that is copied.
    `extra_keys` maps a name to (point key, array of target keys) and narrows
    the equi-join, for example by day. Rows without coordinates never match.
    Neither side is hinted; a hot cell is left to skew-join splitting.
    """
    height, width = cell_sides_deg(radius_m, sphere_m)
    p_lat, p_lon = F.col(point_at[0]), F.col(point_at[1])
    t_lat, t_lon = F.col(target_at[0]), F.col(target_at[1])

    left = points.filter(p_lat.isNotNull() & p_lon.isNotNull()).withColumns(
        {"_cy": cell_of(p_lat, height), "_cx": cell_of(p_lon, width)}
    )
    right = targets.filter(t_lat.isNotNull() & t_lon.isNotNull())
    keys = ["_cy", "_cx"]
    for name, (point_key, target_keys) in (extra_keys or {}).items():
        left = left.withColumn(name, point_key)
        right = right.withColumn(name, F.explode(target_keys))
        keys.append(name)
    right = right.select("*", F.inline(box_cells(t_lat, t_lon, radius_m, sphere_m)))

    metres = haversine_m(p_lat, p_lon, t_lat, t_lon, sphere_m)
    # the latitude band is a cheap test that spares most of the trigonometry
    band = F.abs(p_lat - t_lat) <= math.degrees(radius_m / sphere_m) + _EPS_DEG
    condition = band & (metres <= radius_m)
    if residual is not None:
        condition = condition & residual
    return left.join(right, keys, "inner").filter(condition).withColumn(distance, metres).drop(*keys)


def _clipped(windows: DataFrame, incidents: DataFrame) -> DataFrame:
    """Incidents cut to the time range of the windows.

    Open-ended incidents would otherwise be listed for every bucket of the far future.
    """
    first, last = windows.agg(F.min("window_start"), F.max("window_start")).first()
    lower, upper = (F.lit(v).cast("timestamp") for v in (first, last))
    cut = incidents.withColumns({"_from": F.greatest("start_time", lower), "_to": F.least("end_time", upper)})
    return cut.filter(F.col("_from") <= F.col("_to"))


def incident_pairs(
    windows: DataFrame, incidents: DataFrame, radius_m: float = 500.0, bucket_days: int = 7
) -> DataFrame:
    """Windows with every incident active at that time within the radius, bounds included.

    Incidents are listed per cell and per time bucket. A bucket of a week keeps
    the copies of long-running incidents few and still spreads a busy cell over
    many keys; the exact time test is part of the join condition either way.
    """
    return radius_pairs(
        windows, _usable(windows, incidents), radius_m, ("lat_mean", "lon_mean"), ("_lat", "_lon"),
        sphere_m=MEAN_RADIUS_M,
        extra_keys={"_bucket": (_bucket("window_start", bucket_days), _buckets(bucket_days))},
        residual=F.col("window_start").between(F.col("start_time"), F.col("end_time")),
    ).drop("_lat", "_lon", "_from", "_to")


def _bucket(instant: str, days: int) -> Column:
    return F.floor(F.unix_timestamp(instant) / (days * 86_400))


def _buckets(days: int) -> Column:
    return F.sequence(_bucket("_from", days), _bucket("_to", days))


def _usable(windows: DataFrame, incidents: DataFrame) -> DataFrame:
    """What matches need of the incidents that can be active at a window."""
    valid = incidents.filter(F.col("start_time") <= F.col("end_time"))
    return _clipped(windows, valid).select(
        "event_id", "deviation_id", "start_time", "end_time", "_from", "_to",
        "severity_code", "affected_road",
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
    )


def _blocks_of(rows: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """Number of blocks of the keys that hold more than `size` rows: at most one row per `size` rows of the table."""
    return rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).alias(name)).filter(F.col(name) > 1)


def incident_matches(
    windows: DataFrame, incidents: DataFrame, radius_m: float = 500.0, bucket_days: int = 7
) -> DataFrame:
    """The summary of `incident_pairs`, keyed by (trip_id, window_start), without a row for each pair.

    Windows and incidents are dealt by cell and time bucket, as there, and meet sorted in a task that compares
    them as matrices (`matching`). A meeting of too many rows is cut: a window then meets each block of its
    incidents, an incident each block of its windows. What moves is the windows, the copies of the incidents
    and one row per window with matches.
    """
    height, width = cell_sides_deg(radius_m, MEAN_RADIUS_M)
    cell = ["_cy", "_cx", "_bucket"]
    usable = _usable(windows, incidents).filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    placed = windows.filter(F.col("lat_mean").isNotNull() & F.col("lon_mean").isNotNull() & F.col("window_start").isNotNull())
    left = placed.select(
        cell_of(F.col("lat_mean"), height).alias("_cy"), cell_of(F.col("lon_mean"), width).alias("_cx"), _bucket("window_start", bucket_days).alias("_bucket"),
        F.lit(1).alias("_kind"), F.col("lat_mean").cast("double").alias("_lat"), F.col("lon_mean").cast("double").alias("_lon"),
        F.unix_micros(F.col("window_start").cast("timestamp")).alias("_t0"), "trip_id",
    )
    severity = F.coalesce(F.col("severity_code").try_cast("int").cast("bigint"), F.lit(matching.NO_SEVERITY))
    # the number keeps small tables from being handled in one task: copies and comparisons are the work, not bytes
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    right = usable.repartition(parts).withColumn("_bucket", F.explode(_buckets(bucket_days)))
    right = right.select("*", F.inline(box_cells(F.col("_lat"), F.col("_lon"), radius_m, MEAN_RADIUS_M))).select(
        *cell, F.lit(0).alias("_kind"), F.col("_lat").cast("double"), F.col("_lon").cast("double"),
        *[F.unix_micros(F.col(c).cast("timestamp")).alias(n) for c, n in (("start_time", "_t0"), ("end_time", "_t1"))],
        severity.alias("_severity"), "event_id", "deviation_id", "affected_road",
    )
    # one row per block of a full table at most, whatever the data
    busy = _blocks_of(left, cell, BLOCK_WINDOWS, "_wn").join(_blocks_of(right, cell, BLOCK_INCIDENTS, "_in"), cell, "full")
    busy = F.broadcast(written(busy, "blocks"))
    one, wn, many = F.lit(1), F.coalesce("_wn", F.lit(1)), F.coalesce("_in", F.lit(1))

    def dealt(rows: DataFrame, own: str, blocks: Column, by: list[str], other: str, copies: Column) -> DataFrame:
        block = F.pmod(F.xxhash64(*by), blocks)
        known = rows.join(busy, cell, "left").withColumn(own, block)
        return known.withColumn(other, F.explode(F.sequence(one - 1, copies - 1).cast("array<bigint>"))).drop("_wn", "_in")

    meeting = dealt(left, "_wb", wn, ["trip_id", "_t0", "_lat", "_lon"], "_ib", many).unionByName(
        dealt(right, "_ib", many, ["event_id", "deviation_id", "_t0", "_t1", "_lat", "_lon"], "_wb", wn), allowMissingColumns=True
    ).withColumns({"_t1": F.coalesce("_t1", F.lit(0)), "_severity": F.coalesce("_severity", F.lit(matching.NO_SEVERITY))})
    sorted_rows = meeting.repartition(parts, *matching.MEETING).sortWithinPartitions(*matching.MEETING, "_kind", "_t0", "event_id", "deviation_id")
    kinds = {f.name: f.dataType.simpleString() for f in sorted_rows.schema}
    entry = f"array<struct<_t0:bigint,event_id:{kinds['event_id']},deviation_id:{kinds['deviation_id']},affected_road:{kinds['affected_road']}>>"
    schema = f"trip_id {kinds['trip_id']}, _at bigint, _n bigint, _severity bigint, _roads {entry}"
    sums = sorted_rows.mapInArrow(matching.matches(radius_m), schema)
    # a window of several blocks, or of several rows, has several sums
    roads = F.array_sort(F.flatten(F.collect_list("_roads")))
    text = F.array_join(F.array_distinct(F.transform(roads, lambda r: r["affected_road"])), ",")
    return sums.groupBy("trip_id", F.timestamp_micros("_at").cast(windows.schema["window_start"].dataType).alias("window_start")).agg(
        F.sum("_n").alias("num_nearby_traffic_events"),
        F.max("_severity").cast("double").alias("nearby_event_severity"),
        F.nullif(text, F.lit("")).alias("affected_roads"),
    )


def incident_summary(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Count, highest numeric severity and distinct roads per window that has matches.

    Roads appear in the order of the earliest incident that names them. They
    are made distinct before they are gathered, so the list is the output text
    and nothing more.
    """
    first_seen = F.min(F.struct("start_time", "event_id", "deviation_id"))
    per_road = pairs.groupBy(*keys, "affected_road").agg(
        F.count("*").alias("_n"),
        F.max(F.col("severity_code").try_cast("int")).alias("_severity"),
        first_seen.alias("_seen"),
    )
    roads = F.array_sort(
        F.collect_list(F.when(F.col("affected_road").isNotNull(), F.struct("_seen", "affected_road")))
    )
    text = F.array_join(F.transform(roads, lambda r: r["affected_road"]), ",")
    return per_road.groupBy(*keys).agg(
        F.sum("_n").alias("num_nearby_traffic_events"),
        F.max("_severity").cast("double").alias("nearby_event_severity"),
        F.nullif(text, F.lit("")).alias("affected_roads"),
    )


def incident_features(windows: DataFrame, incidents: DataFrame, radius_m: float = 500.0) -> DataFrame:
    """Every window with its incident features; zeros and nulls where nothing is near.

    Matches are rare, but a planner guesses a radius join to be huge and would
    shuffle every window to meet them. The summary is therefore written first:
    its real size then decides between a broadcast and a shuffle join.
    """
    keys = ["trip_id", "window_start"]
    # read for their time range, their blocks and their matches
    slim = written(windows.select(*keys, "lat_mean", "lon_mean"), "windows")
    summary = written(incident_matches(slim, incidents, radius_m), "incidents")
    count = F.coalesce("num_nearby_traffic_events", F.lit(0)).cast("bigint")
    return windows.join(summary, keys, "left").withColumns(
        {"num_nearby_traffic_events": count, "has_nearby_event": (count > 0).cast("bigint")}
    )


_VISIT_COLUMNS = ["trip_id", "route_short_name", "route_long_name", "trip_headsign", "stop_name", "stop_headsign"]


def _minute_ends(stops: DataFrame, payload: list[str]) -> DataFrame:
    """First and last visit of every place in each minute of the clock, with the clock hour."""
    rest = [c for c in payload if c != "trip_id"]
    row = ["trip_id", "stop_sequence", *rest]
    clock = F.col("_arrival")
    return (
        stops.withColumn("_arrival", clock_seconds(F.col("arrival_time")))
        .groupBy("stop_lat", "stop_lon", F.floor(clock / 3600).alias("_hour"), F.floor(clock / 60).alias("_minute"))
        .agg(
            F.min(F.struct(clock.alias("_rank"), *row)).alias("_first"),
            F.min(F.struct((-clock).alias("_rank"), *row)).alias("_last"),
        )
        .drop("_minute")
    )


def nearest_trip(requests: DataFrame, stops: DataFrame, max_radius_m: float = 500.0) -> DataFrame:
    """For each request (request_id, lat, lon, at) the best scheduled stop around it.

    Stops inside the radius beat stops inside twice the radius; among those
    that remain, stops served within an hour of the request beat the others;
    then distance, arrival gap, trip and sequence decide.

    The place is settled first: each place carries the first and last arrival
    of its clock hours, which tell whether it is served in time, so no visit
    is joined to a place that loses. The circle widens until it holds a place
    served in time, so a request is compared with the places of that circle
    and not of the widest. Only the winning place of a request then
    meets visits: both ends of the other hours, and the ends of each minute of
    the request's own hour. Every other visit is further away in time.
    """
    payload = [c for c in _VISIT_COLUMNS if c in stops.columns]
    place = ["stop_lat", "stop_lon"]
    target_s = F.hour("at") * 3600 + F.minute("at") * 60
    target, hour = F.col("_target"), F.floor(F.col("_target") / 3600)
    wanted = requests.select("request_id", "lat", "lon", target_s.alias("_target"))

    # the visits are read once; hours and places are made from their minutes
    minutes = written(_minute_ends(stops, payload), "visits")
    hours = minutes.groupBy(*place, "_hour").agg(F.min("_first").alias("_first"), F.min("_last").alias("_last"))
    # one short entry per clock hour, whatever the number of visits
    spans = minutes.groupBy(*place, "_hour").agg(F.min("_first._rank").alias("early"), F.max(-F.col("_last._rank")).alias("late"))
    served = written(spans.groupBy(*place).agg(F.collect_list(F.struct("early", "late")).alias("_served")), "served")

    def in_time(ends: Column) -> Column:
        # visits of the own hour are always in time, of other hours the nearer end is
        own = F.coalesce(F.floor(ends["early"] / 3600) == hour, F.lit(False))
        return own | within_seconds(ends["early"], target) | within_seconds(ends["late"], target)

    tier = F.when(F.col("distance_m") <= max_radius_m, 0).otherwise(2) + F.when(
        F.exists("_served", in_time), 0
    ).otherwise(1)
    # rank keeps places that tie; losers are dropped before the shuffle
    order = Window.partitionBy("request_id").orderBy("_tier", "distance_m")
    left, found = written(wanted, "requests"), []
    for reach in (max_radius_m / 8, max_radius_m / 2, max_radius_m, max_radius_m * 2):
        # requests are copied, as places carry their hours
        near = radius_pairs(served, left, reach, tuple(place), ("lat", "lon"))
        ranked = near.select("request_id", "_target", *place, "distance_m", tier.alias("_tier"))
        best = ranked.withColumn("_rank", F.rank().over(order)).filter("_rank = 1").drop("_rank")
        # what a wider circle adds is further away, and beats only places that are not served in time
        settled = best.filter(F.col("_tier") <= (0 if reach < max_radius_m else 1 if reach == max_radius_m else 3)).drop("_tier")
        found.append(written(settled, "nearest"))
        if reach <= max_radius_m:
            ids = found[-1].select(F.col("request_id").alias("_settled")).distinct()
            left = written(left.join(ids, F.col("request_id").eqNullSafe(F.col("_settled")), "left_anti"), "requests")
            if left.isEmpty():
                break
    chosen = reduce(DataFrame.unionByName, found)

    # equal arrivals have one winner at both ends, which need not be compared twice
    last = F.when(F.col("_last._rank") != -F.col("_first._rank"), F.col("_last"))
    visit = F.explode(F.filter(F.array("_first", last), F.isnotnull)).alias("_visit")
    wanted_columns = ["request_id", "_target", "distance_m", visit]
    other_hours = chosen.join(hours, place).filter(~F.coalesce(F.col("_hour") == hour, F.lit(False))).select(*wanted_columns)
    own_hour = chosen.withColumn("_hour", hour).join(minutes, [*place, "_hour"]).select(*wanted_columns)
    gap = F.coalesce(F.abs(F.abs(F.col("_visit._rank")) - target), F.lit(2**31 - 1))
    best = (
        other_hours.unionByName(own_hour)
        .groupBy("request_id", "distance_m")
        .agg(F.min_by("_visit", F.struct(gap, F.col("_visit.trip_id"), F.col("_visit.stop_sequence"))).alias("_best"))
    )
    renamed = {"stop_name": "closest_stop", "stop_headsign": "closest_stop_headsign"}
    return best.select(
        "request_id",
        *[F.col(f"_best.{c}").alias(renamed.get(c, c)) for c in payload],
        metres_rounded(F.col("distance_m")).alias("distance_m"),
    )


def nearest_place(
    requests: DataFrame, places: DataFrame, max_radius_m: float = 5000.0, first_radius_m: float = 50.0
) -> DataFrame:
    """Distance from each request (request_id, lat, lon) to its nearest place; none beyond the radius.

    The radius doubles until a request has met a place; only the requests that
    have not go on. A request is thereby compared with the few places of the
    circle in which it finds its first, not with all within the widest radius.
    Places (stop_lat, stop_lon) of equal position count once.
    """
    spots = written(places.select("stop_lat", "stop_lon").distinct(), "places")
    left = written(requests.select("request_id", "lat", "lon"), "requests")
    # every round joins anew: shuffled joins keep what the driver would gather and send out from growing with the tables
    found, radius = [], min(first_radius_m, max_radius_m)
    while True:
        pairs = radius_pairs(left.hint("shuffle_merge"), spots, radius, ("lat", "lon"), ("stop_lat", "stop_lon"))
        # each round feeds the answer and the next round's requests
        found.append(written(pairs.groupBy("request_id").agg(F.min("distance_m").alias("distance_m")), "nearest"))
        if radius >= max_radius_m:
            return reduce(DataFrame.unionByName, found)
        left = left.join(found[-1].hint("shuffle_merge"), "request_id", "left_anti")
        radius = min(radius * 2, max_radius_m)


def closest_stop(requests: DataFrame, stops: DataFrame) -> DataFrame:
    """For each request (request_id, trip_id, lat, lon) the nearest stop of that trip."""
    joined = requests.join(stops, "trip_id")
    metres = haversine_m(F.col("lat"), F.col("lon"), F.col("stop_lat"), F.col("stop_lon"))
    order = F.struct(metres.alias("m"), F.col("stop_sequence"), F.col("stop_id"))
    best = joined.groupBy("request_id").agg(
        F.min_by(F.struct("stop_name", "stop_headsign"), order).alias("_b")
    )
    return requests.select("request_id").join(best, "request_id", "left").select(
        "request_id", "_b.stop_name", "_b.stop_headsign"
    )


def stop_bounds(stops: DataFrame, buffer_deg: float = 0.02) -> DataFrame:
    """Bounding box, buffered box, centroid and count of the distinct stop places."""
    lat, lon = "stop_lat", "stop_lon"
    box = stops.select(lat, lon).distinct().agg(
        F.min(lat).alias("raw_min_lat"), F.max(lat).alias("raw_max_lat"),
        F.min(lon).alias("raw_min_lon"), F.max(lon).alias("raw_max_lon"),
        F.avg(lat).alias("centroid_lat"), F.avg(lon).alias("centroid_lon"),
        F.count("*").alias("num_stops"),
    )
    return box.select(
        (F.col("raw_min_lat") - buffer_deg).alias("min_lat"), (F.col("raw_max_lat") + buffer_deg).alias("max_lat"),
        (F.col("raw_min_lon") - buffer_deg).alias("min_lon"), (F.col("raw_max_lon") + buffer_deg).alias("max_lon"),
        "*",
    )
