"""Mixing sources to target weights by capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import WORD, fresh, query, table
from headway.session import written

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
# hex digits of a document's draw that one refinement step looks at, and the steps
DIGITS, STEPS = 3, 2


def ranked(df: DataFrame, column: str) -> DataFrame:
    """Adds `rank`, 0 upwards in ascending order of `column`, nulls last.

    A range sort numbers the rows of each partition; the driver sees one count per partition only.
    """
    ordered = df.orderBy(F.col(column).asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id())
    placed = written(ordered, "mix-ranked")
    counts = placed.groupBy(F.shiftright("_at", 33).alias("part")).count().collect()
    first, before = {}, 0
    for part, n in sorted((r["part"], r["count"]) for r in counts):
        first[part], before = before, before + n
    pairs = [F.lit(x) for item in (first or {0: 0}).items() for x in item]
    offset = F.create_map(*pairs)[F.shiftright("_at", 33)]
    return placed.withColumn("rank", offset + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at")


def water_fill(sources: DataFrame, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to rows with `source_size` and `weight`.

    All targets together are `share_percent` of all sizes, in proportion to the weights. A target above
    `max_epochs` times its source is clamped there and the excess goes to the others by weight, again and
    again until none is above. If every source is clamped, the rest stays undistributed. The driver sees
    three sums per round; each round clamps at least one source more.
    """
    cap = max_epochs * F.col("source_size")
    level, over = None, -1
    while True:
        clamped = F.lit(False) if level is None else cap * level[1] <= F.col("weight") * level[0]
        got = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(clamped, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(clamped.cast("int")).alias("n"),
        ).first()
        if not got["total"] or not got["open"] or got["n"] == over:
            break
        # exact whole numbers, in hundredths of a word
        level = float(share_percent * got["total"] - 100 * got["capped"]), float(100 * got["open"])
        over = got["n"]
    if not got["total"]:
        target = F.lit(0.0)
    elif not got["open"]:
        target = cap.cast("double")
    else:
        target = F.when(clamped, cap.cast("double")).otherwise(F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
    return sources.withColumn("target", target)


def mixed(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS,
          share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """How many words the mix takes of each row of `docs` (doc_id, text, source).

    Size is the number of words, 0 for a null or empty text. Sources in code point order, null last, get
    `weights` in turn. Each source is repeated whole as often as its target holds it; the rest of the target
    is a fractional repetition: documents in the order of a seeded draw (ties: doc_id, size) until it is
    full, the last one in part. Taken words of a source are therefore its rounded target. Returns row_id,
    doc_id, text_md5, source, size, source_size, weight, target, whole, part, taken. Other columns are not read.
    """
    sizes = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")).alias("text_md5"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")).alias("draw"),
    )
    sizes = written(sizes, "mix-sizes")
    sources = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    turn = F.array(*[F.lit(w) for w in weights])
    sources = sources.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    sources = written(water_fill(sources, share_percent, max_epochs), "mix-sources")
    goal = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    plan = sources.select(
        F.col("source").alias("_source"), "source_size", "weight", "target", whole.alias("whole"),
        (goal - whole * F.col("source_size")).cast("long").alias("rest"), F.lit("").alias("cell"),
    )
    # narrow the draw at which the fractional repetition ends: sums per cell of draws, never a sort of all rows
    for _ in range(STEPS):
        plan = _narrowed(sizes, plan)
    joined = sizes.join(plan, sizes["source"].eqNullSafe(plan["_source"])).drop("_source")
    prefix = F.substring("draw", 1, DIGITS * STEPS)
    edge = joined.where(prefix == F.col("cell"))
    before = Window.partitionBy("source").orderBy("draw", "doc_id", "size", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("size").over(before), F.lit(0))
    edge = edge.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - used)))
    clear = joined.where(prefix != F.col("cell")).withColumn("part", F.when(prefix < F.col("cell"), F.col("size")).otherwise(0))
    return clear.unionByName(edge).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))


def _narrowed(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """One step: the cell of draws, DIGITS hex digits longer, in which each source's rest runs out."""
    inside = sizes.join(plan.select("_source", "cell"), sizes["source"].eqNullSafe(F.col("_source"))).drop("source")
    at = F.length("cell")
    inside = inside.where(F.col("draw").substr(F.lit(1), at) == F.col("cell"))
    cells = inside.groupBy("_source", F.col("draw").substr(F.lit(1), at + DIGITS).alias("next")).agg(F.sum("size").alias("n"))
    # at most 16 ** DIGITS rows a source
    upto = Window.partitionBy("_source").orderBy("next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("upto", F.sum("n").over(upto)).withColumnRenamed("_source", "_cell_source")
    known = cells.join(plan.select("_source", "rest"), F.col("_cell_source").eqNullSafe(F.col("_source")))
    ends = known.where(F.col("upto") > F.col("rest")).groupBy("_source").agg(
        F.min_by(F.struct("next", (F.col("upto") - F.col("n")).alias("used")), "next").alias("end"))
    ends = ends.withColumnRenamed("_source", "_end_source")
    # without an end the whole cell is used up: "g" sorts after every hex digit
    found = plan.join(ends, plan["_source"].eqNullSafe(F.col("_end_source")), "left").select(
        "_source", "source_size", "weight", "target", "whole",
        (F.col("rest") - F.coalesce("end.used", F.lit(0))).alias("rest"), F.coalesce("end.next", F.lit("g")).alias("cell"))
    return written(found, "mix-cells")


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of `docs` as often as the mix takes it, whole documents only.

    A document that the fractional repetition takes in part counts as taken if that part is at least half.
    """
    took = mixed(docs, **options)
    copies = F.col("whole") + F.when((F.col("size") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    took = took.groupBy(F.col("doc_id").alias("_mix_id"), F.col("text_md5").alias("_mix_md5"), F.col("source").alias("_mix_source")).agg(
        F.sum(copies).alias("_mix_copies"), F.count("*").alias("_mix_rows"))
    key, turn, n = fresh(docs, "text_md5", "mix_row", "mix_turn")
    marked = docs.withColumn(key, F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")))
    on = marked["doc_id"].eqNullSafe(took["_mix_id"]) & (marked[key] == took["_mix_md5"]) & marked["source"].eqNullSafe(took["_mix_source"])
    joined = marked.join(took, on).withColumn("_mix_each", F.ceil(F.col("_mix_copies") / F.col("_mix_rows")).cast("int"))
    out = joined.where(F.col("_mix_each") > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col("_mix_each"))))
    return out.select([F.col(f"`{c}`") for c in docs.columns])


_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS draw FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM src),
ordered AS (
  SELECT *, sum(2 * source_size) OVER o AS caps, sum(weight) OVER o AS used, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM weighed WINDOW o AS (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
tried AS (
  SELECT *, ({SHARE_PERCENT} * total - 100 * (caps - 2 * source_size)) * weight >= 200 * source_size * (weights - used + weight) AS clamped FROM ordered),
level AS (
  SELECT {SHARE_PERCENT} * max(total) - 100 * coalesce(sum(CASE WHEN clamped THEN 2 * source_size END), 0) AS num,
         100 * sum(CASE WHEN clamped THEN 0 ELSE weight END) AS den FROM tried),
aims AS (
  SELECT source, source_size, CASE WHEN clamped THEN 2.0::DOUBLE * source_size::DOUBLE ELSE weight::DOUBLE * num::DOUBLE / den::DOUBLE END AS target FROM tried, level),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN (floor(target + 0.5)::BIGINT // source_size) ELSE 0 END AS whole FROM aims),
run AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, floor(p.target + 0.5)::BIGINT - p.whole * p.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest - used)))::BIGINT AS taken FROM run
"""


@query("op9_mixing", _SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
