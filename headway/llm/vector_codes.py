"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, by dual-tree Lloyd rounds.

Blocks of vectors are stored once, each part position with a tree over its parts: the parts in tree order,
and the box and the sum of every leaf; boxes and sums of the nodes above follow from these. In a round every
block meets a tree over the entries of each codebook. Pairs of nodes go down both trees together: an entry
node farther from a part node than another entry node can be at most is dropped for all parts below. A part
node left with one entry is assigned whole by its cached sum; parts of leaves that stay uncertain are
compared in whole numbers. Only sums and counts of entries leave the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import Scratch, query, table
from headway.llm.vectors import by_width, scaled, sql_fits

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# vectors of one block, and parts of one leaf at least
BLOCK_ROWS, LEAF_ROWS = 4096, 16

_FAR = np.iinfo(np.int64).max


def halves(points: np.ndarray, depth: int) -> np.ndarray:
    """Order of `points` in a tree of 2**depth leaves: every node is cut in the middle of its widest dimension."""
    order, n = np.arange(len(points)), len(points)
    for level in range(depth):
        edges = cuts(n, level + 1)
        for begin, middle, end in zip(edges[:-1:2], edges[1::2], edges[2::2]):
            own = order[begin:end]
            values = points[own]
            along = values[:, np.argmax(np.ptp(values, axis=0))]
            order[begin:end] = own[np.argpartition(along, middle - begin)]
    return order


def cuts(n: int, level: int) -> np.ndarray:
    """Borders of the 2**level nodes of a level over n points; those of a level are among those of the next."""
    return n * np.arange((1 << level) + 1) // (1 << level)


def levels(leaves: np.ndarray, combine) -> list[np.ndarray]:
    """Values of all nodes from those of the leaves, the root's level first."""
    out = [leaves]
    while len(out[0]) > 1:
        out.insert(0, combine(out[0][::2], out[0][1::2]))
    return out


class EntryTree:
    """Boxes of the nodes over a codebook. Every level holds the nodes in order; `parents` leads to the level above."""

    def __init__(self, entries: np.ndarray):
        depth = max(len(entries) - 1, 0).bit_length()
        # a tree of whole halves needs 2**depth points: the last entry is repeated and the copies are never alive
        full = np.concatenate([entries, np.repeat(entries[-1:], (1 << depth) - len(entries), axis=0)])
        self.order = halves(full, depth)
        self.low = levels(full[self.order], np.minimum)
        self.high = levels(full[self.order], np.maximum)
        self.real = levels(self.order < len(entries), np.logical_or)


def bounds(low: np.ndarray, high: np.ndarray, entry_low: np.ndarray, entry_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between points of each box and each entry box."""
    above = low[:, None] - entry_high[None]
    below = entry_low[None] - high[:, None]
    least = np.maximum(np.maximum(above, below), 0)
    most = np.maximum(-above, -below)
    return np.einsum("ijk,ijk->ij", least, least), np.einsum("ijk,ijk->ij", most, most)


class PartTree:
    """The parts of a block at one position, in tree order, with the boxes and sums of the leaves."""

    def __init__(self, order: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.order, self.points = order, points.astype(np.int64)
        self.low, self.high = levels(low.astype(np.int64), np.minimum), levels(high.astype(np.int64), np.maximum)
        self.sums = levels(sums, np.add)

    @staticmethod
    def grown(points: np.ndarray) -> tuple[np.ndarray, ...]:
        depth = max((len(points) // LEAF_ROWS).bit_length() - 1, 0)
        order = halves(points, depth)
        points, starts = points[order], cuts(len(points), depth)[:-1]
        return order, points, np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), np.add.reduceat(points.astype(np.int64), starts)

    def assigned(self, entries: np.ndarray, coded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Sums and counts of the parts of each entry, and with `coded` the entry of every part in tree order."""
        tree, n = EntryTree(entries), len(self.points)
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        codes = np.empty(n, np.uint8) if coded else None
        level, entry_level, last, entry_last = 0, 0, len(self.low) - 1, len(tree.low) - 1
        nodes, alive = np.zeros(1, np.int64), np.ones((1, 1), bool)
        while True:
            least, most = bounds(self.low[level][nodes], self.high[level][nodes], tree.low[entry_level], tree.high[entry_level])
            alive &= least <= np.where(alive, most, _FAR).min(axis=1, keepdims=True)
            if entry_level == entry_last:
                edges, single = cuts(n, level), alive.sum(axis=1) == 1
                for node, entry in zip(nodes[single], tree.order[alive[single].argmax(axis=1)]):
                    sums[entry] += self.sums[level][node]
                    counts[entry] += edges[node + 1] - edges[node]
                    if coded:
                        codes[edges[node]:edges[node + 1]] = entry
                nodes, alive = nodes[~single], alive[~single]
                if level == last:
                    break
            if entry_level < entry_last:
                entry_level += 1
                alive = np.repeat(alive, 2, axis=1) & tree.real[entry_level]
            if level < last:
                level += 1
                nodes, alive = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel(), np.repeat(alive, 2, axis=0)
        if len(nodes):
            edges = cuts(n, last)
            sizes = edges[nodes + 1] - edges[nodes]
            at = np.repeat(edges[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            own = alive[:, np.argsort(tree.order)[:len(entries)]]  # by number of the entry, so that ties go to the lower one
            nearest = np.where(np.repeat(own, sizes, axis=0), self._distances(at, entries), _FAR).argmin(axis=1)
            np.add.at(sums, nearest, self.points[at])
            counts += np.bincount(nearest, minlength=len(entries))
            if coded:
                codes[at] = nearest
        return sums, counts, codes

    def _distances(self, at: np.ndarray, entries: np.ndarray) -> np.ndarray:
        out = np.empty((len(at), len(entries)), np.int64)
        for number, entry in enumerate(entries):
            apart = self.points[at] - entry
            out[:, number] = np.einsum("ij,ij->i", apart, apart)
        return out


def _packer(width: int, parts: int, label: pa.DataType):
    part = width // parts

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            while many >= BLOCK_ROWS:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, BLOCK_ROWS))
                held, many = whole.slice(BLOCK_ROWS).to_batches(), many - BLOCK_ROWS
        if many:
            yield block(pa.Table.from_batches(held))

    def block(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        (_, matrix), = by_width(rows.column("v").chunk(0))
        trees = [PartTree.grown(matrix[:, i * part:(i + 1) * part]) for i in range(parts)]
        kinds = "<u2", "<i4", "<i4", "<i4", "<i8"
        values = [[x.astype(kind).tobytes() for x in column] for kind, column in zip(kinds, zip(*trees))]
        lists = [pa.array([rows.column(c).to_pylist()], pa.list_(t)) for c, t in (("vec_id", pa.int64()), ("label", label))]
        return pa.RecordBatch.from_arrays(lists + [pa.array([v], pa.list_(pa.binary())) for v in values], ["vec_ids", "labels", *_TREE])

    return packed


_TREE = ["orders", "points", "lows", "highs", "sums"]
_TOTALS = pa.schema([("place", pa.int32()), ("total", pa.int64()), ("many", pa.int64())])


def _trees(batch: pa.RecordBatch, row: int, part: int) -> Iterator[PartTree]:
    for values in zip(*(batch.column(name)[row].as_py() for name in _TREE)):
        order, *rest = (np.frombuffer(x, kind) for x, kind in zip(values, ("<u2", "<i4", "<i4", "<i4", "<i8")))
        yield PartTree(order, *(x.reshape(-1, part) for x in rest))


def _round(codebooks: np.ndarray):
    parts, entries, part = codebooks.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        places = np.arange(codebooks.size, dtype=np.int32)
        for batch in batches:
            for row in range(batch.num_rows):
                for position, tree in enumerate(_trees(batch, row, part)):
                    own, many, _ = tree.assigned(codebooks[position], False)
                    sums[position] += own
                    counts[position] += many
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(sums.ravel()), pa.array(np.repeat(counts.ravel(), part))], schema=_TOTALS)

    return summed


def _coder(codebooks: np.ndarray, label: pa.DataType):
    parts, _, part = codebooks.shape

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = batch.column("vec_ids")[row].values, batch.column("labels")[row].values
                codes, errors = np.empty((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for position, tree in enumerate(_trees(batch, row, part)):
                    _, _, own = tree.assigned(codebooks[position], True)
                    apart = tree.points - codebooks[position][own]
                    codes[tree.order, position] = own
                    errors[tree.order] += np.einsum("ij,ij->i", apart, apart)
                text, width = codes.tobytes().hex(), 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([text[i:i + width] for i in range(0, len(text), width)]), pa.array(errors), labels], ["vec_id", "code", "error", "label"])

    return coded


def first_entries(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The starting codebooks: the vectors of the `entries` smallest vec_ids, cut into parts; None without vectors.

    The length of the first one is that of the table. Of rows with equal vec_id the smallest vector is taken,
    and a null vec_id comes after all others. The driver reads one row, `entries` ids and their vectors.
    """
    nothing = F.col("vec_id").isNull()
    vectors = vectors.where(F.size("v") % parts == 0)
    first = vectors.agg(F.min(F.struct(nothing.alias("last"), "vec_id", "v")).alias("least")).first().least
    if first is None:
        return None
    alike = vectors.where(F.size("v") == len(first.v))
    ids = [r.vec_id for r in alike.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    chosen = alike.where(F.coalesce(wanted, F.lit(False)) | (nothing & F.lit(None in ids)))
    rows = chosen.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("vec_id")).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), parts, -1).swapaxes(0, 1)


def lloyd_round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each entry becomes the floor of the mean of its parts; unused entries stay."""
    totals = blocks.select(*_TREE).mapInArrow(_round(codebooks), "place int, total long, many long").groupBy("place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("many").alias("many"))
    new = codebooks.copy().ravel()
    for row in totals.where("many > 0").collect():  # one row for each component of the codebooks
        new[row.place] = int(row.total) // row.many
    return new.reshape(codebooks.shape)


def compressed(rows: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors of `rows` (vec_id, embedding, label) and the codebooks, parts x entries x length of a part.

    The frame has vec_id, label, code (the entry numbers, two hex digits each) and error (the squared distance
    to the entries, scaled). At most 256 entries. Vectors that `vectors.scaled` leaves out, whose length
    `parts` does not divide or that differ in length from the one of the smallest vec_id take no part. Fewer
    distinct vec_ids than `entries` give as many entries. Repeated rows count each time; a null vec_id or label
    is kept. Without vectors the frame is empty and so are the codebooks. Rounds that change nothing end the
    search, as all later ones would change nothing either.
    """
    spark, label = rows.sparkSession, rows.schema["label"].dataType
    vectors = scaled(rows, scale, F.col("vec_id").cast("long").alias("vec_id"), "label")
    codebooks = first_entries(vectors, parts, entries)
    out = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("label", label)])
    if codebooks is None:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64)
    width, scratch = codebooks[:, 0].size, Scratch(spark)
    arrow_label = rows.select("label").limit(0).toArrow().schema.field("label").type
    binaries = ", ".join(f"{name} array<binary>" for name in _TREE)
    packer = _packer(width, parts, arrow_label)
    blocks = scratch.write(vectors.where(F.size("v") == width).mapInArrow(packer, f"vec_ids array<long>, labels array<{label.simpleString()}>, {binaries}"), "code-blocks")
    for _ in range(rounds):
        before, codebooks = codebooks, lloyd_round(blocks, codebooks)
        if (before == codebooks).all():
            break
    return blocks.mapInArrow(_coder(codebooks, arrow_label), out), codebooks


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with label_error, the error summed over the rows of an equal label; nulls are one label."""
    held = Scratch(coded.sparkSession).write(coded, "codes")
    sums = held.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return held.join(sums, held["label"].eqNullSafe(sums["_label"])).drop("_label")


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def _sql() -> str:
    part = f"(position - 1) // (width // {PARTS})"
    steps = [f"""
rows AS (
  SELECT row_number() OVER () AS row_id, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) % {PARTS} = 0 AND {sql_fits(SCALE)})
  QUALIFY len(v) = first_value(len(v)) OVER (ORDER BY vec_id, v)),
parts AS MATERIALIZED (
  SELECT row_id, vec_id, {part} AS part, (position - 1) % (width // {PARTS}) AS place, value
  FROM (SELECT row_id, vec_id, len(v) AS width, unnest(v) AS value, generate_subscripts(v, 1) AS position FROM rows)),
first AS (
  SELECT row_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
  FROM (SELECT row_id, vec_id FROM rows QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v, row_id) = 1) ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, place, value FROM parts JOIN first USING (row_id))"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
  SELECT row_id, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (
    SELECT p.row_id, p.part, b.entry, CAST(sum((p.value - b.value) * (p.value - b.value)) AS BIGINT) AS dist
    FROM parts p JOIN book{n} b USING (part, place) GROUP BY ALL) GROUP BY ALL)""")
        if n < ROUNDS:
            steps.append(f"""
book{n + 1} AS MATERIALIZED (
  SELECT part, entry, place, CAST(coalesce(s.value, b.value) AS BIGINT) AS value FROM book{n} b LEFT JOIN (
    SELECT part, entry, place, (sum(value) - ((sum(value) % count(*)) + count(*)) % count(*)) // count(*) AS value
    FROM parts JOIN near{n} USING (row_id, part) GROUP BY ALL) s USING (part, entry, place))""")
    return f"""WITH {",".join(steps)},
coded AS (
  SELECT row_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY row_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{ROUNDS}) AS codebooks_sha256
FROM rows JOIN coded USING (row_id)"""


@query("op13_vector_codes", _sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = compressed(table(spark, sf_dir, "embeddings"))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))
