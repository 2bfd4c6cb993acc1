"""Constraint checks, coverage gates, change detection and audit chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str, name: str) -> DataFrame:
    """constraint, key: child rows whose key has no parent (null keys aren't checked)."""
    known = parent.select(F.col(parent_key).alias("key")).distinct()
    lost = child.filter(F.col(key).isNotNull()).select(F.col(key).alias("key")).join(known, "key", "left_anti")
    return lost.groupBy("key").agg(F.count("*").alias("n")).select(F.lit(name).alias("constraint"), F.col("key").cast("string").alias("key"), "n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def null_gate(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """field, null_rate, max_rate, ok: one pass."""
    bad = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    one = df.agg(*[F.avg(bad(c).cast("int")).alias(c) for c in limits])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.round(c, 6).alias("null_rate"), F.lit(float(m)).alias("max_rate")) for c, m in limits.items()])).alias("x"))
    return rows.select("x.*").withColumn("ok", F.col("null_rate") <= F.col("max_rate"))


def upsert_plan(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, action: insert, update, unchanged or missing; null-safe comparison of all columns."""
    a = old.select(*keys, F.struct(*columns).alias("_old"))
    b = new.select(*keys, F.struct(*columns).alias("_new"))
    action = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "missing").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("update")
    )
    return a.join(b, keys, "full_outer").select(*keys, action.alias("action"))


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table after the upsert: new rows win, others stay."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"))


def chain(events: DataFrame, group: str, order: str, payload: Column) -> DataFrame:
    """Adds ``payload_hash`` and ``previous_hash``: an append-only audit chain."""
    hashed = events.withColumn("payload_hash", F.sha2(payload, 256))
    return hashed.withColumn("previous_hash", F.lag("payload_hash").over(Window.partitionBy(group).orderBy(order)))


def chain_faults(log: DataFrame, group: str, order: str) -> DataFrame:
    """Rows whose previous hash isn't that of the row before, or whose number doesn't follow it."""
    w = Window.partitionBy(group).orderBy(order)
    gap = F.col(order) != F.lag(order).over(w) + 1
    broken = ~F.col("previous_hash").eqNullSafe(F.lag("payload_hash").over(w))
    return log.withColumn("fault", F.when(broken, "hash").when(F.coalesce(gap, F.lit(False)), "sequence")).filter("fault IS NOT NULL")


def gates(values: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """gate, value, threshold, passed, from one row of values; rules: (column, '>=' or '<=', threshold)."""
    rows = [
        F.struct(
            F.lit(c).alias("gate"),
            F.round(F.col(c).cast("double"), 4).alias("value"),
            F.lit(float(t)).alias("threshold"),
            (F.col(c) >= t if op == ">=" else F.col(c) <= t).alias("passed"),
        )
        for c, op, t in rules
    ]
    return values.select(F.explode(F.array(*rows)).alias("g")).select("g.*")


def grid_gaps(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """keys, state: missing, extra or duplicate against an expected grid."""
    n = actual.groupBy(*keys).agg(F.count("*").alias("_n"))
    both = expected.select(*keys).distinct().withColumn("_want", F.lit(True)).join(n, keys, "full_outer")
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_want").isNull(), "extra").when(F.col("_n") > 1, "duplicate")
    return both.withColumn("state", state).filter("state IS NOT NULL").select(*keys, "state")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """By name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
