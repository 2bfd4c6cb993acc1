"""Edges from rows: names resolved, reasons kept for what is left out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import edge_id


def name_index(tables: list[tuple[DataFrame, str, Column]]) -> DataFrame:
    """name, node: names and aliases of several tables (node column, array of names); the first table wins, then the lowest node."""
    views = [
        df.select(F.lit(i).alias("rank"), F.col(node).cast("string").alias("node"), F.explode(names).alias("name")) for i, (df, node, names) in enumerate(tables)
    ]
    every = reduce(lambda a, b: a.unionByName(b), views).filter(F.trim("name") != "")
    return every.groupBy("name").agg(F.min_by("node", F.struct("rank", "node")).alias("node"))


def build(rows: DataFrame, index: DataFrame, verbs: list[str]) -> tuple[DataFrame, DataFrame]:
    """Edges and the rows left out with a reason; rows: source, verb, target (names), evidence, confidence.

    Together they are all rows: bad verb, no evidence, unresolved source or target, self-loop.
    """
    a = index.select(F.col("name").alias("source"), F.col("node").alias("src"))
    b = index.select(F.col("name").alias("target"), F.col("node").alias("dst"))
    found = rows.join(a, "source", "left").join(b, "target", "left")
    reason = (
        F.when(~F.coalesce(F.col("verb").isin(*verbs), F.lit(False)), "bad_verb")
        .when(F.trim(F.coalesce("evidence", F.lit(""))) == "", "no_evidence")
        .when(F.col("src").isNull(), "unresolved_source")
        .when(F.col("dst").isNull(), "unresolved_target")
        .when(F.col("src") == F.col("dst"), "self_loop")
    )
    marked = found.withColumn("reason", reason)
    good = marked.filter("reason IS NULL").withColumn("edge_id", edge_id("src", "verb", "dst"))
    edges = good.groupBy("edge_id", "src", "verb", "dst").agg(
        F.count("*").alias("weight"), F.max("confidence").alias("confidence"), F.min("evidence").alias("evidence")
    )
    return edges.withColumn("review", F.col("confidence") < 0.8), marked.filter("reason IS NOT NULL").select(*rows.columns, "reason")


def overlay(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges lifted to the parents of their ends where these are known, weights summed, loops within a parent dropped."""
    p = parents.select("child", "parent")
    up = edges.join(p.withColumnsRenamed({"child": "src", "parent": "_s"}), "src", "left").join(p.withColumnsRenamed({"child": "dst", "parent": "_d"}), "dst", "left")
    lifted = up.select(F.coalesce("_s", "src").alias("src"), F.coalesce("_d", "dst").alias("dst"), "weight")
    return lifted.filter("src <> dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def domains_of(frames: dict[str, DataFrame], subject: str) -> DataFrame:
    """subject, domains: in which layers a subject occurs, of those in several."""
    views = [df.select(F.col(subject).alias("subject"), F.lit(name).alias("domain")).distinct() for name, df in frames.items()]
    every = reduce(lambda a, b: a.unionByName(b), views)
    got = every.groupBy("subject").agg(F.array_sort(F.collect_set("domain")).alias("domains"))  # at most a domain each
    return got.filter(F.size("domains") > 1)
