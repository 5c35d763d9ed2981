"""Substring dedup: passages that recur across documents, located by sharded Aho-Corasick automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import Scratch, fresh, query, table, words_of

WINDOW = 50
# words of the run whose smallest hash is the anchor of a window
ANCHOR = 8
# words of the documents that one automaton serves, expected number
SHARD_WORDS = 300_000
# windows whose anchors are looked for at a time
STEP = 4096
# stands for a null doc_id: no document is after it
LAST = (1 << 63) - 1

_ROWS = "doc long, mark long, n_words long, anchors array<long>, pieces array<long>, starts array<int>"
_PASSAGES = "anchor long, piece long, first long, last long, several boolean, words string, windows array<long>"
_PHRASES = "anchor long, piece long, first long, phrase string"
_KEPT = "doc_id long, mark long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: int, end: int>>, kept string"
_PASSAGES_ARROW = pa.schema([
    ("anchor", pa.int64()), ("piece", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("several", pa.bool_()),
    ("words", pa.string()), ("windows", pa.list_(pa.int64()))])
_PHRASES_ARROW = pa.schema([("anchor", pa.int64()), ("piece", pa.int64()), ("first", pa.int64()), ("phrase", pa.string())])
_KEPT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])

_BASE = 0x2545F4914F6CDD1D
_BACK = pow(_BASE, -1, 1 << 64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Windows:
    """Hashes of the windows of a word sequence, and their division into pieces.

    The anchor of a window is its run of ANCHOR words with the smallest hash (the first of equal ones), so equal
    windows have equal anchors. Neighbouring windows with the same anchor occurrence form a piece.
    """

    def __init__(self, words: list[bytes]):
        self.n = max(0, len(words) - WINDOW + 1)
        if not self.n:
            return
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        runs = np.zeros(len(words) - ANCHOR + 1, np.uint64)
        for i in range(ANCHOR):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - ANCHOR + 1 + i]
        runs = _mixed(runs)
        inside, at = np.lib.stride_tricks.sliding_window_view(runs, WINDOW - ANCHOR + 1), np.arange(self.n)
        for begin in range(0, self.n, STEP):  # the search copies what it is given
            at[begin:begin + STEP] += inside[begin:begin + STEP].argmin(axis=1)
        self.starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.ends = np.concatenate([self.starts[1:], [self.n]])
        self.anchors = runs[at[self.starts]].view(np.int64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers(_BASE, len(words)))])
        self.back = _powers(_BACK, len(words))

    def hashed(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the word runs from each start up to each end."""
        return _mixed((self.sums[ends] - self.sums[starts]) * self.back[starts]).view(np.int64)

    @property
    def pieces(self) -> np.ndarray:
        return self.hashed(self.starts, self.ends + (WINDOW - 1))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, marks, sizes, anchors, pieces, starts = [], [], [], [], [], []
        for doc, mark, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = words_of(text)
            own = Windows(words)
            if own.n:
                docs.append(LAST if doc is None else doc)
                marks.append(mark)
                sizes.append(len(words))
                anchors.append(own.anchors)
                pieces.append(own.pieces)
                starts.append(own.starts.astype(np.int32))
        lists = [pa.array(x, pa.list_(kind)) for x, kind in ((anchors, pa.int64()), (pieces, pa.int64()), (starts, pa.int32()))]
        columns = [pa.array(x, pa.int64()) for x in (docs, marks, sizes)] + lists
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "n_words", "anchors", "pieces", "starts"])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted pieces of each document; of pieces whose anchor stands in others too, the window hashes."""
    for batch in batches:
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words, rows = words_of(text), []
            own = Windows(words)
            end_of = dict(zip(own.starts.tolist(), own.ends.tolist()))
            every = own.hashed(np.arange(own.n), np.arange(own.n) + WINDOW)
            for piece in wanted:
                start, end = piece["start"], end_of[piece["start"]]
                rows.append({
                    "anchor": piece["anchor"], "piece": piece["piece"], "first": piece["first"], "last": piece["last"], "several": piece["several"],
                    "words": b" ".join(words[start:end + WINDOW - 1]).decode("utf-8", "replace"),
                    "windows": every[start:end] if piece["several"] else None})
            yield pa.RecordBatch.from_pylist(rows, schema=_PASSAGES_ARROW)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest runs of windows of a piece that start in the same earliest document."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            words = row["words"].split(" ")
            firsts = {f["at"]: f["first"] for f in row["firsts"]} if row["several"] else {}
            firsts = [firsts.get(i, row["first"]) for i in range(len(words) - WINDOW + 1)]
            begin = 0
            for at in range(1, len(firsts) + 1):
                if at == len(firsts) or firsts[at] != firsts[begin]:
                    if firsts[begin] < row["last"]:
                        rows.append({"anchor": row["anchor"], "piece": row["piece"], "first": firsts[begin],
                                     "phrase": " ".join(words[begin:at - 1 + WINDOW])})
                    begin = at
        yield pa.RecordBatch.from_pylist(rows, schema=_PHRASES_ARROW)


class Phrases:
    """The automaton of one shard over word numbers; every occurrence of a phrase knows the phrase's earliest document."""

    def __init__(self):
        self.numbers, self.known = {}, {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.compiled = False

    def add(self, phrase: bytes, first: int) -> None:
        key = tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in phrase.split(b" ")])
        first = self.known[key] = min(first, self.known.get(key, first))
        self.automaton.add_word(key, (len(key), first))

    def covered(self, words: list[bytes], doc: int) -> np.ndarray:
        """Which words stand in an occurrence of a phrase that starts in an earlier document."""
        out = np.zeros(len(words) + 1, np.int64)
        if self.numbers:
            if not self.compiled:
                self.automaton.make_automaton()
                self.compiled = True
            for end, (size, first) in self.automaton.iter(tuple([self.numbers.get(w, 0) for w in words])):
                if first < doc:
                    out[end + 1 - size] += 1
                    out[end + 1] -= 1
        return np.cumsum(out[:-1]) > 0


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard, phrases before documents: compiles a shard's automaton and streams its documents through."""
    shard, phrases = None, None
    for batch in batches:
        rows = []
        for now, doc, mark, first, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if now != shard:
                shard, phrases = now, Phrases()
            if first is not None:
                phrases.add(text, first)
                continue
            words = words_of(text)
            gone = phrases.covered(words, LAST if doc is None else doc)
            row = {"doc_id": doc, "mark": mark, "n_words": len(words), "n_removed": int(gone.sum())}
            if row["n_removed"]:
                words = [w for w, g in zip(words, gone) if not g]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                row["spans"] = [{"start": s, "end": e} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]
                row["kept"] = b" ".join(words).decode("utf-8", "replace")
            row["kept_sha256"] = hashlib.sha256(b" ".join(words)).hexdigest()
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=_KEPT_ARROW)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, mark and text as bytes; the mark is a hash of the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Removes from every row of `docs` (doc_id, text) the words of passages that start in an earlier document.

    A word goes if a window of 50 words covers it whose word sequence also starts in a row with a smaller
    doc_id; all windows are judged on the input. A null doc_id comes after all others. Null and empty texts
    have no words. Repeated rows share their id and so keep their words; other columns are not read.

    Confirm: anchors, one for about 22 words, find the pieces that occur in several documents; of an anchor
    with different pieces, window hashes find the earliest document of each window. Runs of windows with one
    earliest document are the recurring phrases. Compile: documents are dealt into shards of bounded size,
    and the phrases that recur in a shard's documents become its automaton, each phrase once. Stream: all
    documents run whole through the automaton of their shard, which locates every occurrence.

    Returns doc_id, mark (xxhash64 of the text), n_words, n_removed, kept_sha256, and for rows that lose words
    spans (the removed word ranges) and kept (the words left, joined by blanks); both null for other rows.
    """
    scratch = Scratch(docs.sparkSession)
    plain = keyed(docs)
    rows = scratch.write(plain.mapInArrow(_scanned, _ROWS), "substring-rows")
    shards = max(1, -(-(rows.agg(F.sum("n_words")).first()[0] or 0) // SHARD_WORDS))
    places = rows.select("doc", "mark", F.explode(F.arrays_zip("anchors", "pieces", "starts")).alias("a")).select(
        "doc", "mark", F.col("a.anchors").alias("anchor"), F.col("a.pieces").alias("piece"), F.col("a.starts").alias("start"))
    shared = places.groupBy(F.col("anchor").alias("_anchor")).agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("_anchor")
    shared = scratch.write(shared, "substring-anchors")
    places = scratch.write(places.join(shared, F.col("anchor") == F.col("_anchor")).drop("_anchor"), "substring-places")
    scratch.drop("substring-rows", "substring-anchors")

    pieces = places.groupBy("anchor", "piece").agg(F.min(F.struct("doc", "mark", "start")).alias("at"), F.max("doc").alias("last"))
    pieces = scratch.write(pieces, "substring-pieces")
    several = pieces.groupBy(F.col("anchor").alias("_anchor")).agg((F.count("*") > 1).alias("several"))
    wanted = pieces.join(several, F.col("anchor") == F.col("_anchor")).groupBy(F.col("at.doc").alias("_doc"), F.col("at.mark").alias("_mark")).agg(
        F.collect_list(F.struct("anchor", "piece", F.col("at.start").alias("start"), F.col("at.doc").alias("first"), "last", "several")).alias("wanted"))
    texts = plain.withColumn("doc", F.coalesce("doc_id", F.lit(LAST))).join(wanted, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark")))
    passages = scratch.write(texts.select("text", "wanted").mapInArrow(_passages, _PASSAGES), "substring-passages")
    scratch.drop("substring-pieces")

    windows = passages.where("several").select("anchor", "piece", "first", F.posexplode("windows").alias("at", "window"))
    earliest = windows.groupBy(F.col("anchor").alias("_anchor"), F.col("window").alias("_window")).agg(F.min("first").alias("_first"))
    earliest = scratch.write(earliest, "substring-windows")
    firsts = windows.join(earliest, (F.col("anchor") == F.col("_anchor")) & (F.col("window") == F.col("_window")))
    firsts = firsts.groupBy(F.col("anchor").alias("_anchor"), F.col("piece").alias("_piece")).agg(
        F.collect_set(F.struct("at", F.col("_first").alias("first"))).alias("firsts"))
    firsts = scratch.write(firsts, "substring-firsts")
    scratch.drop("substring-windows")
    known = passages.join(firsts, (F.col("anchor") == F.col("_anchor")) & (F.col("piece") == F.col("_piece")), "left")
    phrases = known.select("anchor", "piece", "first", "last", "several", "words", "firsts").mapInArrow(_phrases, _PHRASES)
    phrases = scratch.write(phrases.dropDuplicates(["anchor", "piece", "first", "phrase"]), "substring-phrases")
    scratch.drop("substring-passages", "substring-firsts")

    shard = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(shards)).alias("shard")
    ids = phrases.select(F.col("anchor").alias("_anchor"), F.col("piece").alias("_piece"), "first", F.xxhash64("phrase").alias("number"))
    hits = places.join(ids, (F.col("anchor") == F.col("_anchor")) & (F.col("piece") == F.col("_piece"))).where("first < doc")
    hits = hits.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "mark", "_anchor", "_piece", F.col("first").alias("_first"), "number")
    # a phrase goes once to each shard, whatever the number of documents there that hold it
    needed = scratch.write(hits.select(shard, "_anchor", "_piece", "_first", "number").distinct(), "substring-needed")
    scratch.drop("substring-places")
    same = ["_anchor", "_piece", "_first", "number"]
    sent = phrases.select(F.col("anchor").alias("_anchor"), F.col("piece").alias("_piece"), F.col("first").alias("_first"), "phrase", F.xxhash64("phrase").alias("number"))
    none = F.lit(None).cast("long")
    sent = sent.join(needed, same).select("shard", none.alias("doc_id"), none.alias("mark"), F.col("_first").alias("first"), F.col("phrase").cast("binary").alias("text"))
    both = sent.unionByName(plain.select(shard, "doc_id", "mark", none.alias("first"), "text"))
    both = both.repartition("shard").sortWithinPartitions("shard", F.col("first").isNull())
    kept = scratch.write(both.mapInArrow(_located, _KEPT), "substring-kept")
    scratch.drop("substring-phrases", "substring-needed")
    return kept


def without_passages(docs: DataFrame) -> DataFrame:
    """`docs`, all columns, with the recurring passages cut out of the texts.

    A text that loses words becomes its kept words joined by blanks, and n_chars its length; a text that loses
    all of them goes. Other rows stay as they are.
    """
    cut = deduplicated(docs).where("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "kept").distinct()
    mark, kept = fresh(docs, "text_mark", "kept_text")
    cut = cut.withColumnRenamed("kept", kept)
    marked = docs.withColumn(mark, F.xxhash64("text"))
    joined = marked.join(cut, marked["doc_id"].eqNullSafe(cut["_id"]) & (marked[mark] == cut["_mark"]), "left")
    joined = joined.where(F.col(kept).isNull() | (F.col(kept) != ""))
    changed = {"text": F.coalesce(F.col(kept), F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(F.col(kept)).cast(docs.schema["n_chars"].dataType))
    return joined.select([changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
