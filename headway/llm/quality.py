"""Quality rules: counts of each text, and lines that too many documents of a host share."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import keep_rows, query, table, text_key, words_of
from headway.session import written

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# a line is boilerplate of a host if more distinct documents than both of these hold it
LINE_DOCUMENTS = 20
LINE_PERCENT = 2
# a document is depleted if less than this share of its words is left without such lines
MIN_LEFT_PERCENT = 30
# two texts of which at most one word in so many is their own are near copies: (1 - 1/9) / (1 + 1/9) = 0.8
OWN_SHARE = 9

_SCHEMA = (
    "row_id long, doc_id long, text_md5 string, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<struct<line: long, words: long>>"
)


def line_hash(line: bytes) -> int:
    """Signed 64-bit hash of a normalised line: lower case, digits as 0, single blanks."""
    plain = re.sub(r"\d", "0", line.decode("utf-8", "replace").lower())
    return xxhash.xxh3_64_intdigest(" ".join(plain.split())) - (1 << 63)


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of `width` words that occur twice or more in the text, the first time included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + width - max(at, end)
            end = at + width
    return covered


def measure(text: bytes | None) -> dict:
    """The counts of one UTF-8 text, and its lines."""
    text = text or b""
    words = words_of(text)
    points = len(text.decode("utf-8", "replace"))
    seen, doubled, lines = set(), 0, []
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            doubled += line in seen
            seen.add(line)
            lines.append({"line": line_hash(line), "words": n})
    return {
        "n_words": len(words),
        "word_chars": points - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": doubled,
        "n_repeat_words": repeat_words(words),
        "lines": lines,
    }


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = (TaskContext.get().partitionId() << 33) - 1
    for batch in batches:
        rows = []
        for doc, md5, host, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            row += 1
            rows.append({"row_id": row, "doc_id": doc, "text_md5": md5, "host": host} | measure(text))
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema([
    ("row_id", pa.int64()), ("doc_id", pa.int64()), ("text_md5", pa.string()), ("host", pa.string()), ("n_words", pa.int64()),
    ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))),
])


def judged(docs: DataFrame, line_documents: int = LINE_DOCUMENTS, line_percent: float = LINE_PERCENT,
           min_left_percent: float = MIN_LEFT_PERCENT) -> DataFrame:
    """The counts and the verdict of every row of `docs` (doc_id, text, source).

    The host of a document is its source; null is a host of its own. A line is hashed lower-cased, with
    digits as 0 and single blanks. A line is common on a host if more than `line_documents` different texts of
    the host hold it. A document with at least a ninth of its words in other lines counts as itself, by its
    text; one with less is a near copy of the documents that hold its common lines, and counts by the smallest
    hash of these, which near copies share. So exact and near copies do not turn their own text into
    boilerplate, and a notice counts for every document with a text of its own beside it. A line that more
    documents than both limits hold is removed; a document that keeps less than `min_left_percent` of its words
    is rejected, and so is one that fails the base rules. A null or empty text has no words and fails them.
    Repeated rows are judged row by row. Other columns are not read. Returns row_id, doc_id, text_md5, host,
    the counts, base_failed, n_removed_words, kept.
    """
    plain = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")), F.col("source").cast("string"), F.col("text").cast("binary"))
    rows = written(plain.mapInArrow(_measured, _SCHEMA), "quality-rows")
    known = rows.where("n_words > 0").withColumn("text", F.xxhash64("text_md5"))
    place = F.xxhash64(F.col("host").isNull(), "host", "l.line")
    lines = known.select("row_id", "host", "text", F.explode("lines").alias("l")).select("row_id", "text", place.alias("place"), F.col("l.words").alias("words"))
    # one row for each line and text of a host first: a line of every document is then a sum over all tasks
    texts = lines.select("place", "text").distinct().groupBy("place").agg(F.count("*").alias("texts"))
    common = written(texts.where(F.col("texts") > line_documents).select("place"), "quality-common")
    hits = written(lines.join(common, "place", "left_semi").drop("text"), "quality-hits")
    shared = hits.groupBy(F.col("row_id").alias("_row")).agg(F.sum("words").alias("shared"), F.min("place").alias("least"))
    copy = OWN_SHARE * (F.col("n_words") - F.col("shared")) < F.col("n_words")
    documents = known.join(shared, F.col("row_id") == F.col("_row"), "left").select("row_id", "host", F.when(copy, F.col("least")).otherwise(F.col("text")).alias("document"))
    documents = written(documents, "quality-documents")
    hosts = documents.select("host", "document").distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    held = hits.select(F.col("row_id").alias("_row"), "place").join(documents, F.col("row_id") == F.col("_row")).select("place", "host", "document").distinct()
    counts = held.groupBy("place", F.col("host").alias("_host")).agg(F.count("*").alias("n")).where(F.col("n") > line_documents)
    above = counts.join(hosts, counts["_host"].eqNullSafe(hosts["host"])).where(F.col("n") * 100 > line_percent * F.col("host_documents")).select("place")
    removed = hits.join(written(above, "quality-lines"), "place", "left_semi").groupBy(F.col("row_id").alias("_row")).agg(F.sum("words").alias("removed"))
    out = rows.drop("lines").join(removed, F.col("row_id") == F.col("_row"), "left").drop("_row")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("n_removed_words", F.coalesce("removed", F.lit(0))).drop("removed").withColumn("base_failed", failed)
    left = 100 * (F.col("n_words") - F.col("n_removed_words")) >= min_left_percent * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & left)


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that the quality rules keep."""
    return keep_rows(docs, judged(docs, **options).where("kept"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
