"""Connected components of an edge table, without collecting edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Scratch


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of `edges` (a, b longs): root is the smallest node connected with it.

    Large-star and small-star steps alternate until every edge leads to a root; a component of n nodes takes
    about log n rounds. Each step is a grouped minimum and an equi-join, so a node with very many edges is
    pre-aggregated and its rows can be split. Rounds are written to the shared folder; the driver sees two
    numbers per round.
    """
    scratch, turn = Scratch(edges.sparkSession), 0
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = scratch.write(edges, "components-0"), None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if before == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before, turn = state, turn + 1
        current = scratch.write(_small_star(_large_star(current)), f"components-{turn}")
        scratch.drop(f"components-{turn - 1}")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour (or to itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("_a")).agg(F.least(F.min("b"), F.col("_a")).alias("m"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("_a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; edges come with a > b."""
    least = edges.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("m"))
    joined = edges.join(least, F.col("a") == F.col("_a"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("_a").alias("a"), F.col("m").alias("b"))).distinct()
