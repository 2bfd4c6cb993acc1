"""Deduplication: one row of a key, by an explicit order (never by arrival)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], keep_blank: str | None = None) -> DataFrame:
    """The first row of each key.  Rows whose ``keep_blank`` column is blank are all kept.

    One window sort; the key's rows needn't fit in memory.  Blank rows are dealt
    out by a hash of all their columns, so that many of them don't meet in one task.
    """
    salt = F.when(blank(keep_blank), F.xxhash64(*df.columns)) if keep_blank else F.lit(None).cast("long")
    w = Window.partitionBy(*keys, "_salt").orderBy(*order) if keep_blank else Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_salt", salt).withColumn("_rank", F.row_number().over(w))
    chosen = F.col("_rank") == 1
    if keep_blank:
        chosen = chosen | blank(keep_blank)
    return ranked.filter(chosen).drop("_rank", "_salt")


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """As first_per_key, by an aggregate that combines before it shuffles: for keys with very many rows.

    ``order`` must be ascending expressions that tell rows apart.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def by_priority(df: DataFrame, dataset: str, record: str, priority: Column, order: Column, collapse_blank_ids: bool = False) -> DataFrame:
    """First per (dataset, record), then per record the dataset of lowest priority; rows without id stay unless collapsed."""
    keep = None if collapse_blank_ids else record
    once = first_per_key(df, [dataset, record], [order], keep)
    return first_per_key(once.withColumn("_priority", priority), [record], [F.col("_priority"), order], keep).drop("_priority")


def merged(df: DataFrame, key: str, joined: str, filled: str, order: Column) -> DataFrame:
    """One row per key: distinct values of one column joined in order, the first filled value of another, the rest from the first row."""
    rows = Window.partitionBy(key)
    values = F.array_join(F.sort_array(F.collect_set(F.nullif(F.trim(joined), F.lit(""))).over(rows)), "|")
    first = F.first(F.nullif(F.trim(filled), F.lit("")), ignorenulls=True).over(
        rows.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranked = df.withColumns({joined: values, filled: first, "_rank": F.row_number().over(rows.orderBy(order))})
    return ranked.filter("_rank = 1").drop("_rank")


def duplicate_status(df: DataFrame, fingerprint: Column) -> DataFrame:
    """Adds fingerprint, group size and unique / duplicate."""
    n = F.count("*").over(Window.partitionBy("fingerprint"))
    marked = df.withColumn("fingerprint", fingerprint).withColumn("duplicates", n)
    return marked.withColumn("status", F.when(F.col("duplicates") > 1, "duplicate").otherwise("unique"))


def latest_or_tie(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """Newest rows of each key with ``ties``; more than one in the first place is an error to report, not to pick from."""
    w = Window.partitionBy(*keys).orderBy(*newest)
    ranked = df.withColumn("_rank", F.rank().over(w)).filter("_rank = 1").drop("_rank")
    return ranked.withColumn("ties", F.count("*").over(Window.partitionBy(*keys)))


def superseded(df: DataFrame, record: str, replaces: str) -> DataFrame:
    """Rows that no other row replaces."""
    gone = df.filter(F.col(replaces).isNotNull()).select(F.col(replaces).alias(record)).distinct()
    return df.join(gone, record, "left_anti")
