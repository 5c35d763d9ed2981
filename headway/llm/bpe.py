"""BPE encoding and decoding by a table of distinct words.

Tasks split their documents into words and keep, for a block of documents, each word once plus the
position of every word in that table. The block tables meet by word, where each distinct word is
encoded once; the ids go back to the block, which puts them in the place of every word. Only distinct
words and their ids travel, never a row per word of a text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import query, returning_memory, table, words_of
from headway.session import written

TOKENIZER = "word_bpe_49k.json"
# bytes of text of one block, and the parts a block's words are dealt out to
BLOCK_BYTES = 32_000_000
BUCKETS = 512
# ids of one Arrow batch that leaves a task
BATCH_IDS = 1_000_000

_BLOCK = "block long, bucket int, payload binary, doc_ids array<long>, sizes array<long>"
_REPLY = "block long, bucket int, payload binary"
_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])
_REPLY_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(text: str):
    """The tokenizer of a JSON text, on one thread, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_str(text)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


# whole numbers are kept in streams: one byte for each number, and one, two or four more for larger ones
_MID, _TOP, _RAW = 128, 128 + 112 * 256, 128 + 112 * 256 + (15 << 16)


def squeezed(data: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=9).compress(data.tobytes())


def packed(numbers: np.ndarray) -> bytes:
    """Compressed whole numbers below 2**31, few bits for small ones."""
    n = numbers.astype(np.int32)
    mid, top, raw = (n >= _MID) & (n < _TOP), (n >= _TOP) & (n < _RAW), n >= _RAW
    head = n.astype(np.uint8)
    head[mid], head[top], head[raw] = 128 + ((n[mid] - _MID) >> 8), 240 + ((n[top] - _TOP) >> 16), 255
    streams = head, ((n[mid] - _MID) & 255).astype(np.uint8), ((n[top] - _TOP) & 65535).astype("<u2"), n[raw].astype("<u4")
    return joined(*map(squeezed, streams))


def unpacked(data: bytes) -> np.ndarray:
    kinds = np.uint8, np.uint8, "<u2", "<u4"
    head, mid, top, raw = (np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind).astype(np.int32) for x, kind in zip(parted(data), kinds))
    is_mid, is_top, is_raw = (head >= 128) & (head < 240), (head >= 240) & (head < 255), head == 255
    head[is_mid] = _MID + ((head[is_mid] - 128) << 8) + mid
    head[is_top] = _TOP + ((head[is_top] - 240) << 16) + top
    head[is_raw] = raw
    return head


def joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:end])
        at = end
    return out


def places_coded(at: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of word positions, and which words repeat. Words are numbered as they first occur: a first
    occurrence is 0, another one the number of its word among those that repeat."""
    repeats = np.bincount(at, minlength=distinct) > 1
    seen = np.maximum.accumulate(at) if len(at) else at
    first = at > np.concatenate([np.array([-1], np.int32), seen[:-1]])
    return np.where(first, 0, np.cumsum(repeats, dtype=np.int32)[at]), repeats


def places_decoded(codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    at = np.empty(len(codes), np.int32)
    first = codes == 0
    at[first] = np.arange(first.sum())
    at[~first] = np.flatnonzero(repeats)[codes[~first] - 1]
    return at


def _block_rows(block: int, index: dict[bytes, int], places: list[np.ndarray], doc_ids: list, sizes: list[int]) -> pa.RecordBatch:
    """The positions of a block's words, and its distinct words dealt into buckets, in the order they first occur."""
    words = list(index)
    codes, repeats = places_coded(np.concatenate(places), len(words))
    buckets = np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in words), np.int64, len(words))
    payload = joined(packed(codes), packed(buckets), packed(repeats))
    rows = [{"block": block, "bucket": -1, "payload": payload, "doc_ids": doc_ids, "sizes": sizes}]
    by_bucket = np.argsort(buckets, kind="stable")
    for part in np.split(by_bucket, np.flatnonzero(np.diff(buckets[by_bucket])) + 1):
        if len(part):
            payload = zstandard.ZstdCompressor(level=12).compress(b" ".join([words[i] for i in part]))
            rows.append({"block": block, "bucket": int(buckets[part[0]]), "payload": payload})
    return pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    index, places, doc_ids, sizes, held = {}, [], [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or b""
            words = words_of(text)
            places.append(np.fromiter([index.setdefault(w, len(index)) for w in words], np.int32, len(words)))
            doc_ids.append(doc)
            sizes.append(len(words))
            held += len(text)
            if held >= BLOCK_BYTES:
                yield _block_rows(number, index, places, doc_ids, sizes)
                number += 1
                index, places, doc_ids, sizes, held = {}, [], [], [], 0
    if doc_ids:
        yield _block_rows(number, index, places, doc_ids, sizes)


def _encoder(vocabulary):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, bucket, known = load(vocabulary.value), None, {}
        wide = tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        for batch in batches:
            for block, at, payload in zip(*(batch.column(i) for i in range(3))):
                if at.as_py() != bucket:  # rows come sorted by bucket
                    bucket, known = at.as_py(), {}
                words = zstandard.ZstdDecompressor().decompress(payload.as_py()).split(b" ")
                new = [w for w in words if w not in known]
                for word, got in zip(new, tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)):
                    known[word] = got.ids
                own = [known[w] for w in words]
                counts = np.fromiter(map(len, own), np.int64, len(own))
                ids = np.fromiter((i for x in own for i in x), np.int64)
                reply = joined(packed(counts), squeezed(ids.astype("<u4" if wide else "<u2")))
                yield pa.RecordBatch.from_pylist([{"block": block.as_py(), "bucket": bucket, "payload": reply}], schema=_REPLY_ARROW)

    return encoded


def _assembler(vocabulary):
    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(vocabulary.value)
        pieces = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        for batch in batches:
            for payload, doc_ids, sizes, replies in zip(*(batch.column(i) for i in range(4))):
                yield from _documents(payload.as_py(), doc_ids.as_py(), sizes.as_py(), replies.as_py(), pieces)

    return assembled


def _documents(payload: bytes, doc_ids: list, sizes: list[int], replies: list[dict] | None, pieces: list[str]) -> Iterator[pa.RecordBatch]:
    """The documents of a block: ids put at every word's position, and the text that their pieces spell."""
    codes, buckets, repeats = map(unpacked, parted(payload))
    at = places_decoded(codes, repeats)
    by_bucket = np.argsort(buckets, kind="stable")
    kind = "<u4" if len(pieces) > 1 << 16 else "<u2"
    replies = [parted(r["payload"]) for r in sorted(replies or (), key=lambda r: r["bucket"])]
    replies = [(unpacked(n), np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), kind)) for n, ids in replies]
    sizes_got = np.concatenate([r[0] for r in replies]) if replies else np.zeros(0, np.int64)
    flat = np.concatenate([r[1] for r in replies]).astype(np.int32) if replies else np.zeros(0, np.int32)
    if len(sizes_got) != len(buckets):
        raise ValueError(f"{len(buckets)} distinct words, {len(sizes_got)} encoded")
    counts, starts = np.zeros(len(buckets), np.int64), np.zeros(len(buckets), np.int64)
    counts[by_bucket], starts[by_bucket] = sizes_got, np.cumsum(sizes_got) - sizes_got
    spelled = [" ".join([pieces[i] for i in flat[s:s + n].tolist()]) for s, n in zip(starts.tolist(), counts.tolist())]
    rows, held, begin = [], 0, 0
    for doc, size in zip(doc_ids, sizes):
        own = at[begin:begin + size]
        begin += size
        many = counts[own]
        ends = np.cumsum(many)
        inside = np.arange(ends[-1] if size else 0) - np.repeat(ends - many, many)
        rows.append((doc, flat[np.repeat(starts[own], many) + inside], " ".join([s for s in map(spelled.__getitem__, own.tolist()) if s])))
        held += len(inside)
        if held >= BATCH_IDS:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lengths = np.cumsum([0] + [len(r[1]) for r in rows])
    ids = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate([r[1] for r in rows]), pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), ids, pa.array([r[2] for r in rows], pa.string())], schema=_OUT_ARROW)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids and decoded text of every row of `docs` (doc_id, text): doc_id, ids array<int>, decoded string.

    Words are runs between blanks, tabs and line controls; no token of this tokenizer crosses one, so the
    ids of a text are those of its words in order. `path` names the tokenizer file, which the driver reads;
    its size is fixed. Its id-to-piece table has a row per id, so the join that decodes is one by
    position inside the task, at each distinct word. Null and empty texts have no ids and decode to the
    empty text. Repeated rows stay. A text larger than a block makes a block of its own.
    """
    spark = docs.sparkSession
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    blocks = written(plain.mapInArrow(returning_memory(_blocks), _BLOCK), "bpe-blocks")
    words = blocks.where("bucket >= 0").select("block", "bucket", "payload")
    replies = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(returning_memory(_encoder(vocabulary)), _REPLY)
    replies = replies.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("bucket", "payload")).alias("replies"))
    places = blocks.where("bucket < 0").select("block", "payload", "doc_ids", "sizes")
    whole = places.join(replies, F.col("block") == F.col("_block"), "left").select("payload", "doc_ids", "sizes", "replies")
    return whole.mapInArrow(returning_memory(_assembler(vocabulary)), "doc_id long, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text."""
    return encoded(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
