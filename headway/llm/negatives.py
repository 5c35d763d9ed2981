"""Hard negatives: rows of another label whose score is close below that of an anchor's positive.

A score is the inner product of two vectors. Every vector keeps the mean and the deviation of its segments,
few long ones and more short ones. Within a segment the product of two vectors is its length times the
product of the means, plus or minus the product of the deviations, so the summaries bound a score from both
sides. Blocks of rows are bounded against groups of anchors by the long segments, what is left by the short
ones, and only what is left then is scored.

Anchors go in groups of bounded size to all blocks of rows. The blocks of a group are searched in waves that
grow sixteenfold; the best of the waves before are known to the next one, so a task returns only rows that
beat them, and what is shuffled does not grow with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import Scratch, query, table
from headway.llm.vectors import by_width, scaled, sql_fits

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
# percent of the positive's score between which a negative's lies
LOW, HIGH = 50, 95
# segments of a vector, at the first and at the second look
SEGMENTS = 4, 16
# rows of one block, anchors of one group, and anchors bounded at a time
BLOCK_ROWS, GROUP, CHUNK = 2048, 16_384, 512
# blocks of the first wave, and how many times more each further one has
WAVE, GROWTH = 16, 16

_LEAST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
# inner products below this are exact in floating point
_EXACT = 1 << 53


def summary(matrix: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row, both times the root of the segment's length.

    The deviation is enlarged by a little of the segment's norm, which covers all rounding of 32-bit floats.
    """
    width = matrix.shape[1]
    segments = min(segments, width)
    starts = width * np.arange(segments) // segments
    lengths = np.diff(np.append(starts, width))
    plain = matrix.astype(np.float64)
    sums, squares = np.add.reduceat(plain, starts, axis=1), np.add.reduceat(plain * plain, starts, axis=1)
    means = sums / np.sqrt(lengths)
    return means.astype(np.float32), (np.sqrt(np.maximum(squares - means * means, 0)) + 1e-3 * np.sqrt(squares)).astype(np.float32)


class Rows:
    """Vectors of one length with ids, labels and the summaries of their segments."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, summaries: list[tuple[np.ndarray, np.ndarray]]):
        self.ids, self.labels, self.summaries = ids, labels, summaries
        # floating point as long as every inner product of two such rows is exact in it
        largest = int(np.abs(matrix).max(initial=0))
        self.matrix = matrix.astype(np.float64 if matrix.shape[1] * largest ** 2 < _EXACT else np.int64)

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows `at` with an anchor."""
        if self.matrix.dtype == anchor.dtype == np.float64:
            return (self.matrix[at] @ anchor).astype(np.int64)
        return self.matrix[at].astype(np.int64) @ anchor.astype(np.int64)


def best(old: tuple[np.ndarray, np.ndarray], new_scores: np.ndarray, new_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of old and new rows, as many as before: higher scores, then smaller ids; repeated rows once."""
    found, ids = np.append(old[0], new_scores), np.append(old[1], new_ids)
    order = np.lexsort((ids, ~found))  # falls as the score rises, and has no overflow
    found, ids = found[order], ids[order]
    again = np.append(False, (found[1:] == found[:-1]) & (ids[1:] == ids[:-1]) & (ids[1:] != _LAST))
    return found[~again][:len(old[0])], ids[~again][:len(old[0])]


class Goal:
    """Anchors of one length with the windows of scores they look in and the best rows of each window so far.

    `low` and `high` are anchors x windows, `found` and `found_ids` anchors x windows x places; empty places
    have the least score. With `alike` rows of the anchor's label are looked for, else those of others.
    """

    def __init__(self, anchors: Rows, alike: bool, low: np.ndarray, high: np.ndarray, found: np.ndarray, found_ids: np.ndarray):
        self.anchors, self.alike, self.low, self.high = anchors, alike, low, high
        self.known, self.found, self.found_ids = (found, found_ids), found.copy(), found_ids.copy()

    def wanted(self, anchor: int, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Rows whose score, between two bounds, can enter a window of the anchor. Ties may win by their id."""
        floor = np.maximum(self.low[anchor], self.found[anchor, :, -1])
        return ((upper[None] >= floor[:, None]) & (lower[None] <= self.high[anchor][:, None])).any(axis=0)

    def search(self, rows: Rows) -> None:
        for begin in range(0, len(self.anchors.ids), CHUNK):
            some, own = slice(begin, begin + CHUNK), self.anchors
            (means, spreads), (row_means, row_spreads) = own.summaries[0], rows.summaries[0]
            middle, around = (x[some].astype(np.float64) @ y.astype(np.float64).T for x, y in ((means, row_means), (spreads, row_spreads)))
            same = own.labels[some, None] == rows.labels[None]
            suited = (same if self.alike else ~same) & (own.ids[some, None] != rows.ids[None])
            for i in range(len(suited)):
                self._search(begin + i, rows, suited[i], middle[i] - around[i], middle[i] + around[i])

    def _search(self, anchor: int, rows: Rows, suited: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        at = np.flatnonzero(suited & self.wanted(anchor, lower, upper))
        if not len(at):
            return
        # the rows with the highest bounds first: their scores are what the others have to reach
        self._score(anchor, rows, at[np.argsort(-upper[at], kind="stable")[:4 * self.found.shape[2]]])
        at = at[self.wanted(anchor, lower[at], upper[at])]
        for (means, spreads), (row_means, row_spreads) in zip(self.anchors.summaries[1:], rows.summaries[1:]):
            middle = row_means[at].astype(np.float64) @ means[anchor].astype(np.float64)
            around = row_spreads[at].astype(np.float64) @ spreads[anchor].astype(np.float64)
            at = at[self.wanted(anchor, middle - around, middle + around)]
        self._score(anchor, rows, at)

    def _score(self, anchor: int, rows: Rows, at: np.ndarray) -> None:
        own = rows.scores(at, self.anchors.matrix[anchor])
        for window, (low, high) in enumerate(zip(self.low[anchor], self.high[anchor])):
            hit = (own >= max(low, self.found[anchor, window, -1])) & (own <= high)
            if hit.any():
                self.found[anchor, window], self.found_ids[anchor, window] = best(
                    (self.found[anchor, window], self.found_ids[anchor, window]), own[hit], rows.ids[at][hit])

    def news(self) -> tuple[np.ndarray, ...]:
        """Anchor, window, score and id of rows that were not known before."""
        known = [(x[..., None] == y[:, :, None, :]) for x, y in zip((self.found, self.found_ids), self.known)]
        anchor, window, place = np.nonzero((self.found_ids != _LAST) & ~(known[0] & known[1]).any(axis=-1))
        return anchor, window, self.found[anchor, window, place], self.found_ids[anchor, window, place]


_BLOCKS = "block long, width int, ids binary, labels binary, vectors binary, summaries binary"
_BLOCKS_ARROW = pa.schema([("block", pa.int64()), ("width", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "vectors", "summaries"))])
_FOUND = "anchor int, anchor_id long, slot int, score long, vec_id long"
_FOUND_ARROW = pa.schema([("anchor", pa.int32()), ("anchor_id", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal number
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, labels = (rows.column(c).to_numpy().astype("<i8") for c in ("vec_id", "label"))
        for at, matrix in by_width(rows.column("v").chunk(0)):
            shapes = b"".join(x.astype("<f4").tobytes() for n in SEGMENTS for x in summary(matrix, n))
            values = ids[at].tobytes(), labels[at].tobytes(), matrix.astype("<i4").tobytes(), shapes
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((number, matrix.shape[1], *values), _BLOCKS_ARROW.types)], schema=_BLOCKS_ARROW)
            number += 1

    held, many = [], 0
    for batch in batches:
        held.append(batch)
        many += batch.num_rows
        while many >= BLOCK_ROWS:
            whole = pa.Table.from_batches(held)
            yield from block(whole.slice(0, BLOCK_ROWS).to_batches())
            held, many = whole.slice(BLOCK_ROWS).to_batches(), many - BLOCK_ROWS
    if many:
        yield from block(held)


def _rows(width: int, ids: bytes, labels: bytes, vectors: bytes, summaries: bytes) -> Rows:
    ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
    values, out, at = np.frombuffer(summaries, "<f4"), [], 0
    for segments in (min(n, width) for n in SEGMENTS):
        size = len(ids) * segments
        out.append(tuple(values[at + i * size:at + (i + 1) * size].reshape(-1, segments) for i in range(2)))
        at += 2 * size
    return Rows(ids, labels, np.frombuffer(vectors, "<i4").reshape(len(ids), width), out)


def _searcher(shared):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goals = {width: (numbers, Goal(Rows(*rows), *goal)) for width, numbers, rows, goal in shared.value}
        for batch in batches:
            for width, *values in zip(*(batch.column(i) for i in range(1, 6))):
                if width.as_py() in goals:
                    goals[width.as_py()][1].search(_rows(width.as_py(), *(v.as_py() for v in values)))
        for numbers, goal in goals.values():
            anchor, window, found, ids = goal.news()
            columns = numbers[anchor], goal.anchors.ids[anchor], window, found, ids
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _FOUND_ARROW.types)], schema=_FOUND_ARROW)

    return searched


class Group:
    """A group of at most about GROUP anchors, which the driver holds and sends to all tasks."""

    def __init__(self, anchors: pa.Table):
        anchors = anchors.combine_chunks()
        ids, labels = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
        self.size, self.widths = len(ids), []
        for at, matrix in by_width(anchors.column("v").chunk(0)) if self.size else []:
            self.widths.append((matrix.shape[1], at, (ids[at], labels[at], matrix, [summary(matrix, n) for n in SEGMENTS])))

    def search(self, blocks: DataFrame, waves: int, scratch: Scratch, alike: bool, low: np.ndarray, high: np.ndarray, places: int) -> DataFrame:
        """anchor, anchor_id, slot (number of the window), score, vec_id, rank: the first `places` rows in each window of each anchor."""
        spark, shape = blocks.sparkSession, (*low.shape, places)
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
        share, held = F.pmod(F.xxhash64("block"), F.lit(GROWTH ** (waves - 1))), None
        for wave in range(waves):
            found, ids = np.full(shape, _LEAST), np.full(shape, _LAST)
            if held is not None:
                known = held.toArrow()
                at = known.column("anchor").to_numpy(), known.column("slot").to_numpy(), known.column("rank").to_numpy() - 1
                found[at], ids[at] = known.column("score").to_numpy(), known.column("vec_id").to_numpy()
            shared = spark.sparkContext.broadcast([(width, at, rows, (alike, low[at], high[at], found[at], ids[at])) for width, at, rows in self.widths])
            here = share % GROWTH ** (waves - 1 - wave) == 0
            if wave:
                here &= share % GROWTH ** (waves - wave) != 0
            best_rows = blocks.where(here).mapInArrow(_searcher(shared), _FOUND)
            if held is not None:
                best_rows = best_rows.unionByName(held.drop("rank"))
            ranked = best_rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)
            held = scratch.write(ranked, "positives" if alike else "negatives")
            shared.unpersist()
        return held


def hard_negatives(rows: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives of `rows` (vec_id, embedding, label).

    A row's score is its inner product with the anchor, of vectors scaled to whole numbers; higher scores come
    first, ties by smaller vec_id. An anchor's positives are the first `positives` other rows of its label; of
    the rows of other labels with a score of `low` to `high` percent of the positive's the first `negatives`
    are returned: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null vec_id or label, or a vector that `vectors.scaled` leaves out, take no part. Repeated rows
    count once; rows are others if their vec_id is another one. Vectors of different lengths have no score.
    Anchors go through the driver in groups of about GROUP with at most positives x negatives rows each, so
    what it holds has a fixed size.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding", is_anchor.alias("is_anchor"))
    vectors = scaled(plain.where("vec_id IS NOT NULL AND label IS NOT NULL"), scale, "vec_id", "label", "is_anchor")
    blocks = scratch.write(vectors.select("vec_id", "label", "v").mapInArrow(_packed, _BLOCKS), "vector-blocks")
    anchors = scratch.write(vectors.where("is_anchor").select("vec_id", "label", "v").distinct(), "anchors")
    groups, many, waves = -(-anchors.count() // GROUP), blocks.count(), 1
    while many > WAVE * GROWTH ** (waves - 1):
        waves += 1
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for number in range(groups):
        group = Group(anchors.where(F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(groups)) == number).sort("vec_id", "label", "v").toArrow())
        everything = np.full((group.size, 1), _LEAST), np.full((group.size, 1), _LAST)
        near = group.search(blocks, waves, scratch, True, *everything, positives)
        # an anchor has a window for each positive, in their order; those without one are never met
        floors, tops = np.full((group.size, positives), _LAST), np.full((group.size, positives), _LEAST)
        known = near.toArrow()
        at = known.column("anchor").to_numpy(), known.column("rank").to_numpy() - 1
        hundreds, rest = np.divmod(known.column("score").to_numpy(), 100)
        floors[at], tops[at] = low * hundreds - (-low * rest // 100), high * hundreds + high * rest // 100
        named = near.select(F.col("anchor").alias("_anchor"), (F.col("rank") - 1).alias("_slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        hard = group.search(blocks, waves, scratch, False, floors, tops, negatives)
        found = hard.join(named, (F.col("anchor") == F.col("_anchor")) & (F.col("slot") == F.col("_slot")))
        out = out.unionByName(found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return out


SQL = f"""
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {sql_fits(SCALE)}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER hardest AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW hardest AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER hardest <= {NEGATIVES}"""


@query("op11_hard_negatives", SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives(rows, vec_id % 50 == 0)
