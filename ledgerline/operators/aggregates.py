"""Aggregates with a fixed order and explicit ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def set_text(c: str, most: int | None = None, mark: str = "|") -> Column:
    """Distinct values sorted and joined, at most the first few."""
    values = F.sort_array(F.collect_set(F.nullif(F.trim(c), F.lit(""))))
    return F.array_join(F.slice(values, 1, most) if most else values, mark)


def order_text(c: str, order: str, most: int | None = None, mark: str = "|") -> Column:
    """Distinct values in order of first appearance, joined."""
    values = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(c)))), lambda x: x[c]))
    return F.array_join(F.slice(values, 1, most) if most else values, mark)


def top_ids(df: DataFrame, keys: list[str], order: list[Column], value: str, most: int, mark: str = ",") -> DataFrame:
    """keys and the first few values in order as ``evidence``: ranked before they are collected, so lists stay short.

    The rank filter becomes a limit for each group before the shuffle, so a hot key sends a few rows of each task.
    """
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= most)
    return ranked.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value].cast("string")), mark).alias("evidence")
    )


def mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; ties go to the lowest value."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value))).alias("b"))
    return best.select(*keys, F.col(f"b.{value}").alias(value), (-F.col("b.m")).alias("n"))


def with_share(df: DataFrame, measure: str, share: str = "share") -> DataFrame:
    """Adds each row's share of the total; the total is one small aggregate, not a window over all rows."""
    total = df.agg(F.sum(measure).alias("_total"))
    return df.join(F.broadcast(total), F.lit(True)).withColumn(share, F.col(measure) / F.col("_total")).drop("_total")


def min_max_100(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``<column>_norm`` on 0 to 100; a constant column is 50 if positive, else 0."""
    ends = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    df = df.join(F.broadcast(ends), F.lit(True))
    for c in columns:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        df = df.withColumn(f"{c}_norm", F.when(hi > lo, (F.col(c) - lo) / (hi - lo) * 100).when(hi > 0, 50.0).otherwise(0.0))
    return df.drop(*[f"_{n}_{c}" for c in columns for n in ("lo", "hi")])


def contradictions(claims: DataFrame, keys: list[str], value: str) -> DataFrame:
    """All claims of the keys that say more than one distinct value."""
    n = claims.groupBy(*keys).agg(F.count_distinct(value).alias("n_values"))
    return claims.join(n.filter("n_values > 1"), keys)


def reconcile(parents: DataFrame, children: DataFrame, key: str, reported: str, amount: str) -> DataFrame:
    """Sum of children against the reported value: variance, its share in percent, and OK / WARN / FAIL."""
    summed = children.groupBy(key).agg(F.sum(amount).alias("summed"))
    both = parents.join(summed, key, "left").withColumn("summed", F.coalesce("summed", F.lit(0.0)))
    variance = F.col("summed") - F.col(reported)
    percent = F.when(F.col(reported) != 0, variance / F.col(reported) * 100).otherwise(0.0)
    both = both.withColumns({"variance": variance, "variance_pct": percent})
    flag = (
        F.when(F.abs("variance_pct") >= 10, "FAIL").when((F.abs("variance_pct") >= 1) | (F.abs("variance") >= 10_000), "WARN").otherwise("OK")
    )
    return both.withColumn("status", flag)


def multiset_overlap(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows in common (with repeats), both sizes, Jaccard and share of the larger."""
    h = lambda df, n: df.select(F.sha2(F.to_json(F.struct(*columns)), 256).alias("h")).groupBy("h").agg(F.count("*").alias(n))
    both = h(left, "a").join(h(right, "b"), "h", "full_outer").fillna(0)
    s = both.agg(F.sum(F.least("a", "b")).alias("common"), F.sum("a").alias("left_rows"), F.sum("b").alias("right_rows"))
    union = F.col("left_rows") + F.col("right_rows") - F.col("common")
    return s.withColumns(
        {"jaccard": F.round(F.col("common") / union, 6), "of_larger": F.round(F.col("common") / F.greatest("left_rows", "right_rows"), 6)}
    )


def filled_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, rows, filled, rate: one pass over all columns."""
    ok = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""
    one = df.agg(F.count("*").alias("n"), *[F.count(F.when(ok(c), 1)).alias(c) for c in columns])
    rows = one.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns])).alias("x"))
    return rows.select("x.field", F.col("n").alias("n_rows"), "x.filled", F.round(F.col("x.filled") / F.greatest("n", F.lit(1)), 4).alias("rate"))


def set_compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, side: in both, left only or right only; one shuffle of either side."""
    side = lambda df, n: df.select(key).distinct().withColumn(n, F.lit(1))
    both = side(left, "_l").join(side(right, "_r"), key, "full_outer")
    name = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")
    return both.select(key, name.alias("side"))
