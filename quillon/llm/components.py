"""Connected components of an edge table by alternating stars.

A large star links every larger neighbour of a node to the smallest node it knows of, a
small star does so for the smaller neighbours; edges only ever get replaced, never squared,
and the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quillon.llm.common import cut

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b. Each node's neighbours go to the smallest of them and itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "node")
        out = both.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        joined = edges.join(least, F.col("a") == F.col("node"))
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return out.where("a > b")


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their number and hash, observed while they are written."""
    seen = Observation()
    table = cut(edges.distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "edges")
    return table, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b) that is not its own root; root is the
    smallest node that can be reached. A round without a change is the last: edges that are
    stars from the start need only one."""
    edges, last = _kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b"))
    for _ in range(MAX_ROUNDS):
        if not last[0]:
            break
        edges, now = _kept(_star(_star(edges, True), False))
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"the components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
