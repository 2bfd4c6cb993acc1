"""Claims in two times: when a statement holds, and when it was known.  The log is append-only; every view is derived.

log: claim, seq, recorded_at, valid_from, valid_to (null: open), value, retracted.  A later entry of a claim replaces the one before
in what is known from its recorded_at on (entries of one moment by seq); a retraction leaves nothing known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def versions(log: DataFrame) -> DataFrame:
    """claim, value, valid_from, valid_to, known_from, known_to: what was known of each claim, and from when to before when (null: still)."""
    # of the entries of one moment only the last was ever known
    moment = log.groupBy("claim", "recorded_at").agg(F.max_by(F.struct("value", "valid_from", "valid_to", "retracted"), "seq").alias("e"))
    after = F.lead("recorded_at").over(Window.partitionBy("claim").orderBy("recorded_at"))
    each = moment.withColumn("known_to", after).filter(~F.coalesce(F.col("e.retracted"), F.lit(False)))
    return each.select("claim", "e.value", "e.valid_from", "e.valid_to", F.col("recorded_at").alias("known_from"), "known_to")


def _holds(at: Column, low: str, high: str) -> Column:
    return (F.col(low) <= at) & (F.col(high).isNull() | (at < F.col(high)))


def as_known(log: DataFrame, known_at: Column, valid_at: Column | None = None) -> DataFrame:
    """claim, value, valid_from, valid_to as known at a moment; with valid_at, of those that hold then.  One row for a claim at most."""
    before = log.filter(F.col("recorded_at") <= known_at)
    last = before.groupBy("claim").agg(F.max_by(F.struct("value", "valid_from", "valid_to", "retracted"), F.struct("recorded_at", "seq")).alias("e"))
    rows = last.filter(~F.coalesce(F.col("e.retracted"), F.lit(False))).select("claim", "e.value", "e.valid_from", "e.valid_to")
    return rows if valid_at is None else rows.filter(_holds(valid_at, "valid_from", "valid_to"))


def on_days(log: DataFrame, days: DataFrame) -> DataFrame:
    """day, claim, value: for each day what was known at its end and held on it; days: day (a table of any number of days).

    A version meets the days that both its times span: a join on what it spans of each day, made by exploding its own span, so
    that no version meets a day on which it isn't known.
    """
    day = days.select(F.col("day").cast("date").alias("day")).distinct()
    span = day.agg(F.min("day").alias("_first"), F.max("day").alias("_last"))  # one row
    # known at the end of a day: known_from lies before the next day's start, and known_to doesn't
    v = versions(log).select(
        "claim", "value", F.greatest(F.to_date("known_from"), F.to_date("valid_from")).alias("low"),
        F.least(F.date_sub(F.to_date("known_to"), 1), F.date_sub(F.to_date("valid_to"), 1)).alias("high"),
    )
    v = v.join(F.broadcast(span), F.lit(True)).withColumns({"low": F.greatest("low", "_first"), "high": F.least("high", "_last")}).filter("low <= high")
    return v.select("claim", "value", F.explode(F.sequence("low", "high")).alias("day")).join(day, "day").select("day", "claim", "value")


def changes_between(log: DataFrame, one: Column, other: Column) -> DataFrame:
    """claim, change (added, dropped or changed), before, after: how what is known at one moment differs from another."""
    a = as_known(log, one).select("claim", F.struct("value", "valid_from", "valid_to").alias("before"))
    b = as_known(log, other).select("claim", F.struct("value", "valid_from", "valid_to").alias("after"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "dropped").otherwise("changed")
    both = a.join(b, "claim", "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")))
    return both.select("claim", change.alias("change"), F.col("before.value").alias("before"), F.col("after.value").alias("after"))
