"""N-gram Jaccard join: candidates by MinHash bands, Bayesian pruning on growing MinHash prefixes, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import Scratch, keep_rows, query, table, text_key, words_of
from headway.llm.graph import components

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
# 42 bands of 6 values: a pair at the threshold meets in no band with probability 3e-6
BANDS, BAND_VALUES = 42, 6
# values compared before the posterior is looked at again, and the probability below which a pair is dropped
STEP, TOLERANCE = 21, 1e-9
# texts compared with each other in one task, expected number
BLOCK = 256
_COLUMNS = 8192

_SIGNED = "row_id long, doc_id long, text_md5 string, set_key string, bands array<long>"
_SIGNED_ARROW = pa.schema([
    ("row_id", pa.int64()), ("doc_id", pa.int64()), ("text_md5", pa.string()), ("set_key", pa.string()), ("bands", pa.list_(pa.int64()))])
_LINKED = "rep long, texts long, rows long, root long"
_LINKED_ARROW = pa.schema([("rep", pa.int64()), ("texts", pa.int64()), ("rows", pa.int64()), ("root", pa.int64())])

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, BANDS * BAND_VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, BANDS * BAND_VALUES, dtype=np.uint64)
_SALTS = _random.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: bytes | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; of fewer words all make one run, none make none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - width + 1 + i]
    return np.unique(_mixed(total))


def signature(own: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingle hashes."""
    least = np.full(len(_FACTORS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(own), 2048):
        least = np.minimum(least, (np.multiply.outer(own[start:start + 2048], _FACTORS) + _OFFSETS).min(axis=0))
    return least


def bands(values: np.ndarray) -> np.ndarray:
    total = _SALTS.copy()
    for i in range(BAND_VALUES):
        total = _mixed(total + values.reshape(BANDS, BAND_VALUES)[:, i])
    return total.view(np.int64)


def least_matches(percent: int = THRESHOLD_PERCENT, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values, the fewest equal ones with which a similarity of the threshold is still likely enough.

    Posterior of the similarity under a uniform prior: Beta(equal + 1, n - equal + 1).
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    above, out = grid >= percent / 100, {}
    for n in range(STEP, BANDS * BAND_VALUES + 1, STEP):
        for equal in range(n + 1):
            density = equal * np.log(grid) + (n - equal) * np.log1p(-grid)
            density = np.exp(density - density.max())
            if density[above].sum() >= tolerance * density.sum():
                out[n] = equal
                break
    return out


_LEAST = least_matches()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = (TaskContext.get().partitionId() << 33) - 1
    for batch in batches:
        rows = []
        for doc, md5, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            row += 1
            own = shingles(text)
            out = {"row_id": row, "doc_id": doc, "text_md5": md5}
            if len(own):
                out |= {"set_key": xxhash.xxh3_128_hexdigest(own.tobytes()), "bands": bands(signature(own))}
            rows.append(out)
        yield pa.RecordBatch.from_pylist(rows, schema=_SIGNED_ARROW)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(text).tobytes() for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(1, 5)] + [pa.array(sets, pa.binary())], names=["rep", "component", "blocks", "copies", "own"])


def likely(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of signatures stay: values are compared step by step, and a pair goes once the posterior is too small."""
    equal = np.zeros((len(left), len(right)), np.int32)
    alive = np.ones(equal.shape, bool)
    for start in range(0, left.shape[1], STEP):
        for i in range(start, start + STEP):
            equal += left[:, i][:, None] == right[:, i][None, :]
        alive &= equal >= _LEAST[start + STEP]
        if not alive.any():
            break
    return alive


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from a table of the shingles that several of the sets hold, some columns at a time."""
    every = left + right
    names, place, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    held = counts[place] > 1
    owner, at = owner[held], column[place[held]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, _COLUMNS):
        low, high = np.searchsorted(at, [start, start + _COLUMNS])
        part = np.zeros((len(every), _COLUMNS), np.float32)
        part[owner[low:high], at[low:high] - start] = 1
        out += part[:len(left)] @ part[len(left):].T
    return out.astype(np.int64)


def links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which pairs of shingle sets reach the threshold."""
    alive = likely(np.stack([signature(s) for s in left]), np.stack([signature(s) for s in right]))
    i, j = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    out = np.zeros(alive.shape, bool)
    if len(i):
        both = shared_counts([left[x] for x in i], [right[x] for x in j])
        sizes = np.array([len(left[x]) for x in i])[:, None] + np.array([len(right[x]) for x in j])[None, :]
        out[np.ix_(i, j)] = (both * (100 + THRESHOLD_PERCENT) >= THRESHOLD_PERCENT * sizes) & alive[np.ix_(i, j)]
    return out


def _compared(reps: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], own: np.ndarray) -> pa.RecordBatch:
    """Links between the texts of a block (own true) and, if there are others, between both blocks; and a forest of them."""
    if own.all():
        i = j = np.arange(len(reps))
        found = links(sets, sets)
        np.fill_diagonal(found, False)
    else:
        i, j = np.flatnonzero(own), np.flatnonzero(~own)
        found = links([sets[x] for x in i], [sets[x] for x in j])
    texts, rows = np.zeros(len(reps), np.int64), np.zeros(len(reps), np.int64)
    texts[i], rows[i] = found.sum(axis=1), found @ copies[j]
    if not own.all():
        texts[j], rows[j] = found.sum(axis=0), copies[i] @ found
    root = np.arange(len(reps))
    while True:  # every text takes the smallest root it is linked with
        least = root.copy()
        if found.size:
            least[i] = np.minimum(least[i], np.where(found, root[j][None, :], len(reps)).min(axis=1))
            least[j] = np.minimum(least[j], np.where(found, root[i][:, None], len(reps)).min(axis=0))
        if (least == root).all():
            break
        root = least
    kept = texts > 0
    return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (reps, texts, rows, reps[root])], schema=_LINKED_ARROW)


def _blocks_compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by component and pair of blocks; holds the texts of one pair."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = row["component"], row["low"], row["high"]
            if now != key:
                if len(held) > 1:
                    yield _of_rows(held)
                key, held = now, []
            held.append(row)
    if len(held) > 1:
        yield _of_rows(held)


def _of_rows(held: list[dict]) -> pa.RecordBatch:
    sets = [np.frombuffer(r["own"], np.uint64) for r in held]
    first = np.array([r["block"] == r["low"] for r in held])
    return _compared(np.array([r["rep"] for r in held], np.int64), np.array([r["copies"] for r in held], np.int64), sets, first)


def joined(docs: DataFrame) -> DataFrame:
    """Similarity join of `docs` (doc_id, text) with itself on the Jaccard similarity of five-word shingles.

    Words are compared as they are. Texts with equal shingle sets are copies and join as one text. Texts that
    share a band key are in one component; inside a component blocks of texts are compared in pairs: growing
    MinHash prefixes drop pairs whose posterior probability of reaching the threshold is below the tolerance,
    the rest is verified on the whole sets. A component of any size is thus spread over tasks, and only counts
    and a forest of links leave a task, not pairs. A text of fewer than five words is one shingle; null,
    empty and blank texts link with nothing. Repeated rows are copies of each other; other columns are not
    read. Returns a row per row: row_id, doc_id, text_md5, root (a row_id that names the class), class_id (smallest doc_id among the texts connected
    by links; null ids do not count), copies, n_texts (other texts linked), n_links (other rows linked, copies
    among them), first (whether this row is the one of its class that stays: smallest doc_id, then row_id).
    """
    scratch = Scratch(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")), F.col("text").cast("binary"))
    rows = scratch.write(plain.mapInArrow(_signed, _SIGNED), "jaccard-rows")
    sets = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("row_id").alias("rep"), F.count("*").alias("copies"))
    sets = scratch.write(sets, "jaccard-sets")
    reps = sets.join(rows.select("row_id", "doc_id", "text_md5", "bands"), F.col("rep") == F.col("row_id"))
    keys = scratch.write(reps.select("rep", F.explode("bands").alias("band")), "jaccard-bands")
    shared = keys.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("band", "low")
    shared = scratch.write(shared, "jaccard-shared")
    edges = keys.join(shared, "band").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    members = scratch.write(components(edges).select(F.col("node").alias("rep"), F.col("root").alias("component")), "jaccard-members")
    scratch.drop("jaccard-bands", "jaccard-shared")
    found = scratch.write(_verified(docs, rows, sets, members), "jaccard-links")
    scratch.drop("jaccard-members")

    of_text = found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("texts").alias("texts"), F.sum("rows").alias("rows"))
    roots = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    texts = sets.join(of_text, F.col("rep") == F.col("_rep"), "left").drop("_rep")
    texts = texts.join(roots, F.col("rep") == F.col("node"), "left").select(
        F.col("set_key").alias("_key"), F.coalesce("root", "rep").alias("root"), "copies", F.coalesce("texts", F.lit(0)).alias("n_texts"),
        (F.coalesce("rows", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.drop("bands").join(texts, F.col("set_key") == F.col("_key"), "left").drop("_key", "set_key")
    out = scratch.write(out.withColumn("root", F.coalesce("root", "row_id")), "jaccard-out")
    scratch.drop("jaccard-rows", "jaccard-sets", "jaccard-links")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    classes = out.groupBy(F.col("root").alias("_root")).agg(F.min(order).alias("least"))
    return out.join(classes, F.col("root") == F.col("_root")).select(
        "row_id", "doc_id", "text_md5", "root", F.col("least.doc_id").alias("class_id"), F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("row_id") == F.col("least.row_id")).alias("first"))


def _verified(docs: DataFrame, rows: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """rep, texts, rows, root of every text with links, per pair of blocks."""
    sizes = members.groupBy(F.col("component").alias("_component")).agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    sized = members.join(sizes, F.col("component") == F.col("_component")).drop("_component")
    sized = sized.join(sets.select(F.col("rep").alias("_rep"), "copies"), F.col("rep") == F.col("_rep")).drop("_rep")
    sized = sized.join(rows.select("row_id", F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")), F.col("rep") == F.col("row_id")).drop("row_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_md5"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(sized, (F.col("text_md5") == F.col("_md5")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    # a repeated row has the text of its representative twice
    own = texts.select("text", "rep", "component", "blocks", "copies").mapInArrow(_sets, "rep long, component long, blocks int, copies long, own binary")
    own = own.dropDuplicates(["rep"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = own.select("component", "rep", "copies", "own", "block", other).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "rep", "copies", "own", "block")
    keys = ["component", "low", "high"]
    return pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_blocks_compared, _LINKED)


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of linked texts and copies: the one with the smallest doc_id. Texts without words stay."""
    return keep_rows(docs, joined(docs).where("first"), once=True)


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copies", "n_texts", "n_links")
