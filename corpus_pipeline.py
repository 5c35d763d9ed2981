"""From raw documents to token ids: quality rules, near duplicates, recurring passages, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents. The mix repeats whole documents, so the
last stage may have several equal rows for one doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import bpe, jaccard, mixing, quality, substrings
from headway.llm.common import ready, table
from headway.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ready(spark)
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle similarity, the one with the smallest doc_id stays."""
    ready(spark)
    return jaccard.distinct_documents(docs)


def recurring_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start in an earlier document are cut out of the texts."""
    ready(spark)
    return substrings.without_passages(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until each source has its target words."""
    ready(spark)
    return mixing.repeated(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of ids and decoded text of every row of the mix."""
    ready(spark)
    return bpe.digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", recurring_passages),
    ("mixing", source_mix),
    ("BPE", token_ids),
]

# tokenisation and seeded hashes have no SQL; tests hold the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
