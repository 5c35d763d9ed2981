"""Windows and road incidents of two streams, matched in keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headway.functions.geo import MEAN_RADIUS_M
from headway.operators import matching
from headway.operators.spatial import box_cells, cell_of, cell_sides_deg

LATENESS = "10 minutes"
LONGEST = "100 days"
# places that windows without coordinates are spread over; they wait there and meet no incident
NOWHERE = 4096

# rows of a cell and time bucket: windows (_kind 1) and incidents (_kind 0), instants in microseconds
_ROWS = pa.schema([
    ("_kind", pa.int32()), ("_lat", pa.float64()), ("_lon", pa.float64()), ("_t0", pa.int64()), ("_t1", pa.int64()), ("_severity", pa.int64()),
    ("trip_id", pa.string()), ("event_id", pa.string()), ("deviation_id", pa.string()), ("affected_road", pa.string()),
])
_FOUND = "trip_id string, _at bigint, _n bigint, _severity double, _t0 bigint, event_id string, deviation_id string, affected_road string"
_ORDER = [(name, "ascending") for name in ("_kind", "_t0", "event_id", "deviation_id")]


def stream_incident_pairs(
    windows: DataFrame, incidents: DataFrame, radius_m: float = 500.0, lateness: str = LATENESS, longest: str = LONGEST, bucket_days: int = 91
) -> DataFrame:
    """Each window of a stream with what the incidents of another add up to that are active at its start within the radius.

    Both streams meet in a state keyed by grid cell and time bucket, in either order of arrival. A window waits
    until the watermark has passed its start, as no incident that began earlier can still come. Then it is
    compared with the incidents of its key as a matrix (`matching`), so a pair is never a row, and leaves as one row for
    each road it found, the first of them with the number of its matches; without a match as one row, with
    nulls. Windows without coordinates are among these. An incident stays until the watermark has passed its
    end or its bucket; one that is active longer than `longest` stops the stream, rather than fill the state.
    """
    # cells of twice the side: a state holds enough rows for its matrices
    reach, seconds = 2 * radius_m, bucket_days * 86_400
    height, width = cell_sides_deg(reach, MEAN_RADIUS_M)

    def bucket(instant: Column) -> Column:
        return F.floor(F.unix_timestamp(instant) / seconds)

    def text(*names: str) -> list[Column]:
        return [F.col(name).cast("string").alias(name) for name in names]

    none, lat, lon = F.lit(None).cast("string"), F.col("lat_mean").cast("double"), F.col("lon_mean").cast("double")
    placed = lat.isNotNull() & lon.isNotNull()
    left = windows.withWatermark("window_start", lateness).filter(F.col("window_start").isNotNull()).select(
        F.when(placed, cell_of(lat, height)).otherwise(-(1 << 40)).alias("_cy"),
        F.when(placed, cell_of(lon, width)).otherwise(F.pmod(F.xxhash64("trip_id", "window_start"), F.lit(NOWHERE))).alias("_cx"),
        bucket(F.col("window_start")).alias("_bucket"), F.lit(1).alias("_kind"), lat.alias("_lat"), lon.alias("_lon"),
        F.unix_micros("window_start").alias("_t0"), F.lit(0).cast("bigint").alias("_t1"), F.lit(matching.NO_SEVERITY).cast("bigint").alias("_severity"),
        *text("trip_id"), *[none.alias(c) for c in ("event_id", "deviation_id", "affected_road")], F.col("window_start").alias("_at"),
    )

    start, end = F.col("start_time"), F.col("end_time")
    too_long = F.raise_error(F.concat(F.lit(f"incident active longer than {longest}: "), F.col("event_id")))
    right = incidents.withWatermark("start_time", lateness).filter(start <= end)
    right = right.withColumn("end_time", F.when(end > start + F.expr(f"INTERVAL {longest}"), too_long.cast("timestamp")).otherwise(end))
    right = right.withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    severity = F.coalesce(F.col("severity_code").try_cast("int").cast("bigint"), F.lit(matching.NO_SEVERITY))
    right = right.select("*", F.inline(box_cells(F.col("latitude"), F.col("longitude"), reach, MEAN_RADIUS_M))).select(
        "_cy", "_cx", "_bucket", F.lit(0).alias("_kind"), F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon"),
        F.unix_micros("start_time").alias("_t0"), F.unix_micros("end_time").alias("_t1"), severity.alias("_severity"),
        none.alias("trip_id"), *text("event_id", "deviation_id", "affected_road"), start.alias("_at"),
    )

    met = left.unionByName(right).groupBy("_cy", "_cx", "_bucket").applyInPandasWithState(
        _meeting(radius_m, seconds), _FOUND, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)
    return met.select("trip_id", F.timestamp_micros("_at").alias("window_start"), *[c for c in met.columns if c not in ("trip_id", "_at")])


def _meeting(radius_m: float, bucket_seconds: int) -> Callable:
    """State function of one cell and bucket: keeps rows as Arrow bytes and returns the windows that the watermark has passed."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        held = [pa.ipc.open_stream(bytes(state.get[0])).read_all()] if state.exists else []
        fresh = [pa.Table.from_pandas(b[_ROWS.names], schema=_ROWS, preserve_index=False) for b in batches if len(b)]
        rows = pa.concat_tables([*held, *fresh]) if held or fresh else _ROWS.empty_table()
        window, at, ends = (rows.column(c).to_numpy() for c in ("_kind", "_t0", "_t1"))
        over = (int(key[2]) + 1) * bucket_seconds * 1_000_000
        window = window == 1
        closed, ends = window & (at <= mark), np.minimum(ends, over)
        waiting, useful = window & ~closed, ~window & (ends >= mark)
        rest = rows.filter(pa.array(waiting | useful))
        if rest.num_rows:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _ROWS) as out:
                out.write_table(rest.combine_chunks())
            state.update((sink.getvalue().to_pybytes(),))
            # the next window to close, or the time when the last incident can go
            due = at[waiting].min() // 1000 if waiting.any() else ends[useful].max() // 1000 + 1
            state.setTimeoutTimestamp(int(max(due, mark // 1000 + 1)))
        elif state.exists:
            state.remove()
        if closed.any():
            yield _sums(rows.filter(pa.array(closed)), rows.filter(pa.array(~window)), radius_m)

    return step


def _sums(windows: pa.Table, incidents: pa.Table, radius_m: float) -> pd.DataFrame:
    """One row per window and road found, the first of a window with the number of its matches."""
    many = windows.num_rows
    # a window goes by its number
    numbered = windows.set_column(_ROWS.get_field_index("trip_id"), "trip_id", pa.array(np.arange(many)))
    rows = pa.concat_tables([incidents.set_column(_ROWS.get_field_index("trip_id"), "trip_id", pa.array(np.full(incidents.num_rows, -1))), numbered])
    rows = rows.take(pc.sort_indices(rows, sort_keys=_ORDER, null_placement="at_start"))
    for name in matching.MEETING:
        rows = rows.append_column(name, pa.array(np.zeros(rows.num_rows, np.int64)))
    found = list(matching.matches(radius_m)(iter(rows.combine_chunks().to_batches())))
    counts, severities = np.zeros(many, np.int64), np.full(many, np.nan)
    owners, seen = [], []
    for batch in found:
        own = batch.column("trip_id").to_numpy()
        counts[own] = batch.column("_n").to_numpy()
        severities[own] = batch.column("_severity").to_numpy(zero_copy_only=False)
        roads = batch.column("_roads")
        owners.append(np.repeat(own, pc.list_value_length(roads).to_numpy()))
        seen.append(pa.Table.from_struct_array(roads.flatten()))
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    bare = np.setdiff1d(np.arange(many), owner)
    place = np.r_[owner, bare]
    first = np.r_[np.r_[True, owner[1:] != owner[:-1]][:len(owner)], np.ones(len(bare), bool)]

    def texts(name: str) -> list:
        return [*(x for table in seen for x in table.column(name).to_pylist()), *[None] * len(bare)]

    starts = [*(table.column("_t0").to_numpy() for table in seen), np.zeros(len(bare), np.int64)]
    return pd.DataFrame({
        "trip_id": windows.column("trip_id").take(pa.array(place)).to_pylist(), "_at": windows.column("_t0").to_numpy()[place],
        "_n": np.where(first, counts[place], 0), "_severity": severities[place], "_t0": np.concatenate(starts),
        **{name: pd.Series(texts(name), dtype=object) for name in ("event_id", "deviation_id", "affected_road")},
    })


def features_of_pairs(pairs: DataFrame) -> DataFrame:
    """The incident features of windows from the stored rows of `stream_incident_pairs`, one row per window."""
    entry = F.when(F.col("affected_road").isNotNull(), F.struct("_t0", "event_id", "deviation_id", "affected_road"))
    # of a road that several rows of a window name, the earliest counts
    roads = F.array_distinct(F.transform(F.array_sort(F.collect_list(entry)), lambda r: r["affected_road"]))
    count = F.sum("_n")
    return pairs.groupBy("trip_id", "window_start").agg(
        count.alias("num_nearby_traffic_events"), F.max(F.nanvl("_severity", F.lit(None).cast("double"))).alias("nearby_event_severity"),
        F.nullif(F.array_join(roads, ","), F.lit("")).alias("affected_roads"), (count > 0).cast("bigint").alias("has_nearby_event"),
    )
