"""Which sources are due: by age, by what they depend on, and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.linkage import waves
from ..sources.cache import CADENCE


def due(policies: DataFrame, state: DataFrame, needs: DataFrame, now: Column) -> DataFrame:
    """source, reason: never fetched, stale for its cadence, or a parent that has other content than was consumed.

    policies: source, cadence; state: source, fetched_at, content_hash, consumed (map of parent to hash);
    needs: source, parent.  Paused cadences (none of the known) are never due by age.
    """
    seconds = F.create_map(*[F.lit(x) for pair in CADENCE.items() for x in pair])
    own = policies.join(state, "source", "left")
    age = F.unix_timestamp(now) - F.unix_timestamp("fetched_at")
    by_age = own.withColumn("limit", F.try_element_at(seconds, F.col("cadence")))
    parents = state.select(F.col("source").alias("parent"), F.col("content_hash").alias("parent_hash"))
    moved = (
        needs.join(parents, "parent")
        .join(state.select("source", "consumed"), "source")
        .filter(~F.try_element_at("consumed", F.col("parent")).eqNullSafe(F.col("parent_hash")))
        .select("source")
        .distinct()
        .withColumn("moved", F.lit(True))
    )
    reason = (
        F.when(F.col("fetched_at").isNull(), "never_fetched").when(F.col("moved"), "parent_changed").when(age > F.col("limit"), "stale")
    )
    return by_age.join(moved, "source", "left").withColumn("reason", reason).filter("reason IS NOT NULL").select("source", "reason")


def plan(due_sources: DataFrame, needs: DataFrame) -> DataFrame:
    """source, reason, wave: due sources in the order of their dependencies on one another."""
    nodes = due_sources.select(F.col("source").alias("node"))
    among = needs.select(F.col("source").alias("node"), F.col("parent").alias("needs"))
    among = among.join(nodes, "node", "left_semi").join(nodes.select(F.col("node").alias("needs")), "needs", "left_semi")
    return due_sources.join(waves(among, nodes).withColumnRenamed("node", "source"), "source")
