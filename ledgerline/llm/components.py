"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, release


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """edges: u, v.  Returns node, root (the smallest node of its component) for every node of an edge.

    A round is two aggregations by node and two joins, both safe for a node with
    very many edges: the aggregation combines before it shuffles, the join can be
    split.  Rounds grow with the logarithm of the longest path.  Each round is
    written down, so nothing is computed twice and lineage stays short.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = materialise(e, "edges")
    before = _print_of(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = (
            least.select("u", F.col("m").alias("v"))
            .unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        new = materialise(new, "edges")
        now = _print_of(new)
        release(e)
        e = new
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
