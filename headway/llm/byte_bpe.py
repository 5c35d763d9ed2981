"""Byte-level BPE by a tree of joins: halves are encoded, neighbours joined at their border.

The ids of two neighbouring strings are joined by encoding the bytes around the border again. The window
grows, on the side that needs it, until the token before it and the token after it both hold: two tokens
hold if encoding their bytes alone gives these two tokens. Merges go by rank, so while nothing crosses the
border of a pair, the whole string merges inside the pair just as the pair alone does. The first merge that
crosses a border would therefore also cross it in the pair alone, and a border of two tokens that hold is
never crossed. Hence tokens of which all neighbours hold are the encoding of the whole string, and those
outside the window stay as they are. Decoding puts the bytes of the ids together, up the same tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import query, returning_memory, table

RANKS = "byte_bpe_multi_50k.tiktoken"
# bytes that one leaf of the tree merges without a join
LEAF_BYTES = 16
# matches taken from a text at a time, and ids decoded by one leaf
STEP = 1 << 16
# encoded matches that a task remembers, and bytes of one Arrow batch that leaves it
KNOWN = 1 << 18
BATCH_BYTES = 4_000_000

# above every rank
NO_RANK = 1 << 62

_OUT = "doc_id long, ids binary, decoded binary"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks of a file of lines `base64 rank`, and the pattern whose matches are encoded."""
    import public_tokenizers

    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    return ranks, public_tokenizers.PATTERN


class Codec:
    """Encodes and decodes with `ranks`; every single byte must have one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.known, self.pairs = {}, {}

    def merged(self, data: bytes) -> list[int]:
        """Ids of a string by merging its pairs, lowest rank first and leftmost among equals."""
        if len(data) > LEAF_BYTES:
            return self._merged_long(data)
        rank_of, parts = self.ranks.get, [data[i:i + 1] for i in range(len(data))]
        ranks = [rank_of(data[i:i + 2], NO_RANK) for i in range(len(data) - 1)]
        while ranks and (best := min(ranks)) != NO_RANK:
            at = ranks.index(best)
            whole = parts[at] = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(whole + parts[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + whole, NO_RANK)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap, for windows of many bytes. `ends` of a part that was merged away is 0."""
        rank_of, n = self.ranks.get, len(data)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(data[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, at, end = heappop(heap)
            middle = ends[at]
            if not middle or middle >= n or ends[middle] != end:  # a part of this pair has changed since
                continue
            ends[at], ends[middle] = end, 0
            if end < n:
                before[end] = at
                if (r := rank_of(data[at:ends[end]])) is not None:
                    heappush(heap, (r, at, ends[end]))
            if (left := before[at]) >= 0 and (r := rank_of(data[left:end])) is not None:
                heappush(heap, (r, left, end))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[data[at:ends[at]]])
            at = ends[at]
        return ids

    def holds(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of two neighbouring tokens."""
        held = self.pairs.get((a, b))
        if held is None:
            if len(self.pairs) >= KNOWN:
                self.pairs.clear()
            held = self.pairs[a, b] = self.merged(self.pieces[a] + self.pieces[b]) == [a, b]
        return held

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring strings put together, from the ids of each."""
        if not left or not right or self.holds(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            middle = self.merged(b"".join([self.pieces[t] for t in left[-i:] + right[:j]]))
            left_holds = i == len(left) or self.holds(left[-i - 1], middle[0])
            right_holds = j == len(right) or self.holds(middle[-1], right[j])
            if left_holds and right_holds:
                return left[:-i] + middle + right[j:]
            i = i if left_holds else min(2 * i, len(left))
            j = j if right_holds else min(2 * j, len(right))

    def tree(self, data: bytes) -> list[int]:
        """Ids of one match: halves encoded, then joined."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = len(data) // 2
        return self.joined(self.tree(data[:half]), self.tree(data[half:]))

    def match(self, text: str) -> bytes:
        """Ids of one match, unsigned 32-bit little-endian. A match with a rank of its own is one token."""
        data = text.encode()
        rank = self.ranks.get(data)
        tokens = self.tree(data) if rank is None else [rank]
        ids = pack(f"<{len(tokens)}I", *tokens)
        if len(data) <= 64:  # long matches hardly come again
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text. Matches are encoded separately, so at their borders a join is a concatenation."""
        found, known, out = self.pattern.finditer(text), self.known.get, []
        while matches := [m.group() for m in islice(found, STEP)]:
            out.append(b"".join([known(m) or self.match(m) for m in matches]))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids, those of the halves put together."""
        if len(ids) <= STEP:
            return b"".join(map(self.pieces.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _coder(vocabulary):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, rows, held = Codec(*vocabulary.value), [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = codec.encode((text.as_py() or b"").decode("utf-8", "replace"))
                rows.append((doc.as_py(), ids, codec.decode(np.frombuffer(ids, "<u4"))))
                held += len(ids) + len(rows[-1][2])
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    return coded


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT_ARROW.types)], schema=_OUT_ARROW)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids and decoded bytes of every row of `docs` (doc_id, text): doc_id, ids, decoded, both binary.

    `ids` holds unsigned 32-bit little-endian numbers. `path` names the file of ranks, which the driver
    reads; its size is fixed. A text is coded whole by the task that reads it, so nothing is shuffled;
    what a task remembers is bounded. Null and empty texts have no ids and decode to no bytes. Special
    tokens in a text are ordinary text. Repeated rows stay; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(returning_memory(_coder(shared)), _OUT)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded bytes."""
    return encoded(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
