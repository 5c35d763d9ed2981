"""Matches of windows and incidents, counted where they meet.

The rows of one cell, time bucket and pair of blocks come sorted to one task: incidents first, by the order in
which they began, then windows by time. The task holds the incidents of one block and tiles of windows and
compares them as matrices, so a pair is never a row: a window leaves with its count, its highest severity and
the first incident of each road. Work is windows times incidents of a cell, memory a block and a tile.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from headway.functions.geo import MEAN_RADIUS_M

# cells of one matrix of comparisons, windows of a tile at most, slots of first incidents a tile keeps
TILE, TILE_WINDOWS, TILE_SLOTS = 262_144, 256, 4_194_304
# cosines nearer to the bound than this are settled by the distance itself
SLACK = 1e-13
# the severity of incidents that have none
NO_SEVERITY = -(1 << 63)
# columns that name a meeting
MEETING = ["_cy", "_cx", "_bucket", "_wb", "_ib"]
_NEVER = (1 << 63) - 1


def _metres(lat1, lon1, lat2, lon2) -> np.ndarray:
    """The distance of `haversine_m`."""
    phi1, phi2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((phi2 - phi1) / 2) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    a = np.minimum(a, 1.0)
    return np.arctan2(np.sqrt(a), np.sqrt(1 - a)) * (2 * MEAN_RADIUS_M)


class _Rows:
    """The numbers of a run of sorted rows."""

    def __init__(self, table: pa.Table):
        def numbers(name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        self.lat, self.lon, self.begin, self.end, self.severity = map(numbers, ("_lat", "_lon", "_t0", "_t1", "_severity"))
        phi, lam = np.radians(self.lat), np.radians(self.lon)
        self.at = np.stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)], 1)
        self.road = pc.fill_null(table.column("affected_road").combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        self.is_window = numbers("_kind") == 1
        keys = [numbers(name) for name in MEETING]
        changed = np.any([k[1:] != k[:-1] for k in keys], 0)
        self.starts = np.flatnonzero(np.r_[True, changed])
        self.stops = np.r_[self.starts[1:], len(self.lat)]
        # incidents come first, so their number in a meeting says where its windows start
        before = np.r_[0, np.cumsum(~self.is_window)]
        self.turns = self.starts + before[self.stops] - before[self.starts]


def _tile(rows: _Rows, lo: int, hi: int, a: int, b: int, road: np.ndarray, n_roads: int, radius_m: float):
    """Windows lo..hi against incidents a..b: matches, severity, and the places of the first incident of each road."""
    least, count = math.cos(min(radius_m / MEAN_RADIUS_M, math.pi)), hi - lo
    matches, severity = np.zeros(count, np.int64), np.full(count, NO_SEVERITY, np.int64)
    first = np.full(count * n_roads, _NEVER, np.int64)
    live = a + np.flatnonzero((rows.begin[a:b] <= rows.begin[hi - 1]) & (rows.end[a:b] >= rows.begin[lo]))
    width, when = max(1, TILE // count), rows.begin[lo:hi, None]
    for i in range(0, live.size, width):
        some = live[i:i + width]
        cosine = rows.at[lo:hi] @ rows.at[some].T
        hit = np.flatnonzero((cosine >= least - SLACK) & (when >= rows.begin[some]) & (when <= rows.end[some]))
        row, place = hit // some.size, some[hit % some.size]
        near = cosine.ravel()[hit] > least + SLACK
        if not near.all():
            at, to = lo + row[~near], place[~near]
            near[~near] = _metres(rows.lat[at], rows.lon[at], rows.lat[to], rows.lon[to]) <= radius_m
            row, place = row[near], place[near]
        if not row.size:
            continue
        matches += np.bincount(row, minlength=count)
        np.maximum.at(severity, row, rows.severity[place])
        slot = row * n_roads + road[place - a]
        new = first[slot] == _NEVER
        # of the incidents of a slot the one written last counts: the first to begin
        first[slot[new][::-1]] = place[new][::-1]
    return matches, severity, first


def matches(radius_m: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: sorted rows of meetings to the windows that have matches, each with sums of the meeting."""

    def found(table: pa.Table) -> pa.RecordBatch | None:
        rows = _Rows(table)
        windows, counts, severities, owners, places = [], [], [], [], []
        for a, b, c in zip(rows.starts, rows.turns, rows.stops):
            if a == b or b == c:
                continue
            names, road = np.unique(rows.road[a:b], return_inverse=True)
            step = max(1, min(TILE_WINDOWS, TILE_SLOTS // names.size))
            for lo in range(b, c, step):
                n, severity, first = _tile(rows, lo, min(c, lo + step), a, b, road, names.size, radius_m)
                own = np.flatnonzero(n)
                slots = np.flatnonzero(first != _NEVER)
                slots = slots[rows.road[first[slots]] >= 0]
                windows.append(lo + own)
                counts.append(n[own])
                severities.append(severity[own])
                owners.append(lo + slots // names.size)
                places.append(first[slots])
        if not sum(map(len, windows)):
            return None
        window, owner, place = map(np.concatenate, (windows, owners, places))
        seen = table.select(["_t0", "event_id", "deviation_id", "affected_road"]).take(pa.array(place)).combine_chunks()
        entry = pa.StructArray.from_arrays([c.combine_chunks() for c in seen.columns], ["_t0", "event_id", "deviation_id", "affected_road"])
        # windows and owners both rise
        offsets = np.r_[np.searchsorted(owner, window), len(owner)].astype(np.int32)
        own = table.select(["trip_id", "_t0"]).take(pa.array(window)).combine_chunks()
        severity = np.concatenate(severities)
        return pa.RecordBatch.from_arrays([
            own.column(0).combine_chunks(), own.column(1).combine_chunks(), pa.array(np.concatenate(counts)),
            pa.array(severity, mask=severity == NO_SEVERITY), pa.ListArray.from_arrays(pa.array(offsets), entry),
        ], ["trip_id", "_at", "_n", "_severity", "_roads"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            table = table.combine_chunks()
            out = found(table)
            if out is not None:
                yield out
            # the windows of the last meeting may go on; its incidents stay until it is over
            last = table.slice(_last_start(table))
            held = last.filter(pc.equal(last.column("_kind"), 0))

    return run


def _last_start(table: pa.Table) -> int:
    """Where the last meeting of the rows starts."""
    n = table.num_rows
    same = np.ones(n, bool)
    for name in MEETING:
        values = table.column(name).to_numpy()
        same &= values == values[-1]
    return n - int(same.sum())
