"""All queries of the training-data operators."""

from headway.llm import (  # noqa: F401
    bpe, byte_bpe, html, jaccard, licenses, mixing, negatives, quality, simhash, substrings, toxicity, urls, vector_codes,
)
from headway.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
