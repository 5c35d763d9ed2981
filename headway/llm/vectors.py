"""Vectors scaled to whole numbers, and packed into blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# squared distances and inner products of two scaled vectors stay below 2**63
LONG_BITS = 61


def scaled(rows: DataFrame, scale: int, *others: str) -> DataFrame:
    """`others` and `v`, the vector `embedding` with each component x as the whole number floor(scale * x).

    Rows take no part if the vector is null or empty, or if a component is null, not finite, or so large
    that an inner product of two such vectors could pass a long (scale * |x| above sqrt(2**61 / length)).
    """
    vector = F.col("embedding")
    limit = F.sqrt(F.lit(2.0 ** LONG_BITS) / F.size(vector)) - 1

    def fits(x: Column) -> Column:
        return x.isNotNull() & (F.abs(x.cast("double")) * scale <= limit)  # not a number is above every number

    # tried, as later filters on `v` may see rows before the filter here does
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).try_cast("int"))
    return rows.where((F.size(vector) > 0) & F.forall(vector, fits)).select(*others, whole.alias("v"))


def by_width(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length in a column of integer lists."""
    offsets = column.offsets.to_numpy()
    values, widths = column.values.to_numpy(), np.diff(offsets)
    out = []
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        out.append((at, values[offsets[:-1][at][:, None] + np.arange(width)]))
    return out


def sql_fits(scale: int) -> str:
    """The rows of `scaled` as a condition in SQL."""
    fits = f"x IS NOT NULL AND {scale} * abs(CAST(x AS DOUBLE)) <= sqrt({2 ** LONG_BITS}.0 / len(embedding)) - 1"
    return f"embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: NOT ({fits}))) = 0"
