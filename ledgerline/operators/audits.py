"""Checks and links around identities: transfers, id tails, activity before events, missing parents, replacements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import blank
from .joins import asof_before

# Days of the window, confidence inside and outside it, total from which a missing parent counts.
WINDOW_DAYS = 730
TEMPORAL, NAME_ONLY = 0.90, 0.72
HIGH_VALUE = 1_000_000.0


def transfers(rows: DataFrame, known: DataFrame, source: str, target: str, known_id: str) -> DataFrame:
    """Rows between two filled ids whose target is one of the known ids."""
    ids = known.filter(~blank(known_id)).select(F.col(known_id).cast("string").alias("_id")).distinct()
    both = rows.filter(~blank(source) & ~blank(target))
    return both.join(ids, F.col(target).cast("string") == F.col("_id"), "left_semi")


def id_tail(c: Column) -> Column:
    """What follows the last underscore, or the whole id."""
    return F.element_at(F.split(c, "_"), -1)


def by_tail(rows: DataFrame, masters: DataFrame, column: str, master_id: str, order: str) -> DataFrame:
    """rows with ``master``: the id of the masters with the same tail, the last by order, then by id, if several have it; null if none."""
    index = masters.groupBy(id_tail(F.col(master_id)).alias("_tail")).agg(F.max_by(master_id, F.struct(order, master_id)).alias("master"))
    return rows.withColumn("_tail", id_tail(F.col(column))).join(index, "_tail", "left").drop("_tail")


def preceded(events: DataFrame, activity: DataFrame, on: list[str], at: str, active_at: str, window_days: int = WINDOW_DAYS, entities: DataFrame | None = None) -> DataFrame:
    """events with days since the last activity of their key at or before them, method and confidence.

    Only keys of ``entities`` are kept, whether they have any activity or not (without that table: keys with activity).  An event
    without time, without earlier activity or beyond the window stays, by name alone and at the lower confidence.
    """
    keys = (activity if entities is None else entities).select(*on).distinct()
    times = activity.filter(F.col(active_at).isNotNull()).select(*on, active_at)
    found = asof_before(events.join(keys, on, "left_semi"), times, on, at, active_at, active_at, active_at, strict=False)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    days = F.floor((micros(at) - micros("asof_time")) / 86_400_000_000)
    near = F.coalesce(F.col("days") <= window_days, F.lit(False))
    return found.withColumn("days", days).withColumns({
        "method": F.when(near, "exact_normalized_name+temporal").otherwise("exact_normalized_name"),
        "confidence": F.when(near, TEMPORAL).otherwise(NAME_ONLY),
    }).drop("asof_time", "asof_value")


def collapse_suspects(entities: DataFrame, nodes: DataFrame, name: str, parent: str, total: str, node: str, high: float = HIGH_VALUE) -> DataFrame:
    """entities with high_value, in_graph, suspect, method and confidence: of high value without parent, or absent from the graph."""
    seen = nodes.select(F.col(node).alias(name)).filter(~blank(name)).distinct().withColumn("in_graph", F.lit(True))
    out = entities.filter(~blank(name)).join(seen, name, "left").fillna(False, ["in_graph"])
    high_value = F.coalesce(F.col(total), F.lit(0)) >= high
    return out.withColumns({
        "high_value": high_value,
        "suspect": high_value & blank(parent) | ~F.col("in_graph"),
        "method": F.when(blank(parent), "entity_master_unresolved").otherwise("entity_master_parent_lineage"),
        "confidence": F.when(blank(parent), 0.35).otherwise(0.95),
    })


def replacement_faults(rows: DataFrame, record: str, replaces: str, identity: list[str], times: list[str]) -> DataFrame:
    """record, fault: what forbids a replacement.

    duplicate_id, target_missing, replaces_itself, crosses_<column> for each
    identity column (null equals null), predates_target (times in order of rank).
    A record can have several faults.
    """
    again = rows.groupBy(record).agg(F.count("*").alias("_n")).filter("_n > 1").select(record, F.lit("duplicate_id").alias("fault"))
    old = rows.dropDuplicates([record]).select(F.col(record).alias("_id"), *[F.col(c).alias(f"_{c}") for c in [*identity, *times]])
    pairs = rows.filter(F.col(replaces).isNotNull()).join(old, F.col(replaces) == F.col("_id"), "left")
    there = F.col("_id").isNotNull()
    earlier = reduce(lambda rest, t: (F.col(t) < F.col(f"_{t}")) | (F.col(t) == F.col(f"_{t}")) & rest, reversed(times), F.lit(False))
    tests = [("target_missing", ~there), ("replaces_itself", F.col("_id") == F.col(record)), ("predates_target", there & F.coalesce(earlier, F.lit(False)))]
    tests += [(f"crosses_{c}", there & ~F.col(c).eqNullSafe(F.col(f"_{c}"))) for c in identity]
    faults = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))
    return pairs.select(record, F.explode(faults).alias("fault")).unionByName(again)
