"""Resolution of records against references: cascades, places, aliases, restatements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.interim import settled
from .dedup import best_per_key


def cascade(df: DataFrame, row: str, steps: list[tuple[str, DataFrame, str, float]], value: str) -> DataFrame:
    """Adds value, matched_by and confidence from the first step that finds the row.

    steps: (name, table, key, confidence); each table has the key and the value, lowest value first.
    Blank keys match nothing.
    """
    found = by = sure = None
    for name, table, key, confidence in steps:
        hit = f"_{name}"
        one = table.filter(F.trim(F.col(key).cast("string")) != "").groupBy(key).agg(F.min(value).alias(hit))
        df = df.join(one, key, "left")
        got = F.col(hit).isNotNull()
        found = F.col(hit) if found is None else F.coalesce(found, F.col(hit))
        by = F.when(got, name) if by is None else by.when(got, name)
        sure = F.when(got, confidence) if sure is None else sure.when(got, confidence)
    out = df.withColumns({value: found, "matched_by": by.otherwise("none"), "confidence": sure.otherwise(0.0)})
    return out.drop(*[f"_{s[0]}" for s in steps])


def resolve_place(df: DataFrame, code: Column, raw: Column, places: DataFrame, normal: Column) -> DataFrame:
    """Adds place and method: by code, by name as it stands, by normalised name, or unknown.

    places: code, name (normalised), place; a reference of bounded size by nature (counties).
    """
    by_code = places.groupBy(F.col("code").alias("_code")).agg(F.min("place").alias("_pc"))
    by_name = places.groupBy(F.col("name").alias("_name")).agg(F.min("place").alias("_pn"))
    keyed = df.withColumns({"_code": code, "_name": normal, "_raw": F.upper(F.trim(raw))})
    joined = keyed.join(by_code, "_code", "left").join(by_name, "_name", "left")
    method = (
        F.when(F.col("_pc").isNotNull(), "exact_fips")
        .when(F.col("_pn").isNotNull() & (F.col("_raw") == F.col("_name")), "exact_name")
        .when(F.col("_pn").isNotNull(), "normalized_name")
        .otherwise("unknown")
    )
    return joined.withColumns({"place": F.coalesce("_pc", "_pn"), "method": method}).drop("_code", "_name", "_raw", "_pc", "_pn")


def longest_alias(df: DataFrame, row: str, words: Column, aliases: DataFrame, max_words: int) -> DataFrame:
    """row, alias, subject: of the aliases that stand in a text as whole words the longest (ties: first alias).

    An equi-join on the runs of one to max_words words, so texts aren't held against every alias.
    aliases: alias (words divided by one space), subject.
    """
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(max_words)),
            lambda n: F.when(
                F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    runs = df.select(row, F.explode(F.array_distinct(grams)).alias("alias"))
    # runs are many for each row and estimated as one, so they would be taken for small and sent to the driver
    hits = runs.hint("merge").join(aliases, "alias")
    best = hits.groupBy(row).agg(F.min(F.struct((-F.length("alias")).alias("n"), "alias", "subject")).alias("b"))
    return best.select(row, "b.alias", "b.subject")


def by_variants(df: DataFrame, row: str, variants: Column, table: DataFrame, key: str, value: str) -> DataFrame:
    """row, value, variant: the first variant (name, then aliases) that the table knows."""
    each = df.select(row, F.posexplode(variants).alias("place", key))
    hits = each.join(table.groupBy(key).agg(F.min(value).alias(value)), key)
    best = hits.groupBy(row).agg(F.min(F.struct("place", value, key)).alias("b"))
    return best.select(row, F.col(f"b.{value}").alias(value), F.col(f"b.{key}").alias("variant"))


def restated(df: DataFrame, keys: list[str], at: str, record: str) -> DataFrame:
    """Adds ``restates``: the record of the latest strictly earlier date of the same key, if it is the only one of that date."""
    # one shuffle and one sort serve both windows; a hash of the keys goes first, since it is quicker to compare
    rows = df.withColumns({"_h": F.xxhash64(*keys), "_at": F.unix_micros(F.col(at).cast("timestamp"))}).repartition("_h")
    day = Window.partitionBy("_h", *keys, "_at")
    earlier = Window.partitionBy("_h", *keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_day", F.struct(F.min(record).over(day).alias("r"), F.count("*").over(day).alias("n")))
    # a row without a date is earlier than none
    rows = rows.withColumn("_before", F.last(F.when(F.col("_at").isNotNull(), F.col("_day")), ignorenulls=True).over(earlier))
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*keys, at)])
    return rows.withColumn("restates", F.when(whole & (F.col("_before.n") == 1), F.col("_before.r"))).drop("_h", "_at", "_day", "_before")


def agreement(ids: DataFrame, left: str, right: str) -> DataFrame:
    """left, right, shared, disagree for pairs of records; ids: left, right, namespace, a, b (identifiers of either)."""
    both = (F.trim("a") != "") & (F.trim("b") != "")
    return ids.groupBy(left, right).agg(
        F.count(F.when(both & (F.col("a") == F.col("b")), 1)).alias("shared"), F.count(F.when(both & (F.col("a") != F.col("b")), 1)).alias("disagree")
    )


def namespace_conflicts(df: DataFrame, namespace: str, identifier: str, subject: str) -> DataFrame:
    """namespace, identifier, subjects of identifiers that several subjects claim."""
    n = df.filter(F.trim(F.col(identifier).cast("string")) != "").groupBy(namespace, identifier)
    return n.agg(F.count_distinct(subject).alias("subjects")).filter("subjects > 1")


def merged_snapshot(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row per key, the new one if there is one; of repeated rows the first by all columns."""
    rest = [c for c in new.columns if c != key]
    both = new.withColumn("_age", F.lit(0)).unionByName(old.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return best_per_key(both, [key], [F.col("_age"), F.struct(*rest)]).drop("_age")


def self_pairs(df: DataFrame, group: str, role: str, head: str, record: str) -> DataFrame:
    """group, head, member: each member of a group with the group's heads (one equi-join; heads are few by nature)."""
    heads = df.filter(F.col(role) == head).select(group, F.col(record).alias("head"))
    return df.filter(F.col(role) != head).select(group, F.col(record).alias("member")).join(heads, group)


def worst_tier(df: DataFrame, row: str, sources: Column, tiers: DataFrame, order: list[str]) -> DataFrame:
    """row, tier: the worst tier among a row's sources; an unknown source is the last tier."""
    rank = F.create_map(*[F.lit(x) for i, t in enumerate(order) for x in (t, i)])
    each = df.select(row, F.explode_outer(sources).alias("source")).join(tiers, "source", "left")
    worst = F.max(F.coalesce(F.try_element_at(rank, F.col("tier")), F.lit(len(order) - 1)))
    return each.groupBy(row).agg(F.element_at(F.array(*[F.lit(t) for t in order]), worst + 1).alias("tier"))


def waves(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, wave: the length of the longest chain of dependencies below each node (edges: node, needs).

    One join a level, until none is ready.  Nodes on or behind a cycle have no wave: null.
    """
    left = nodes.select("node").distinct()
    done, wave = None, 0
    while True:
        waiting = edges.select("node", F.col("needs").alias("_n")).join(left.select(F.col("node").alias("_n")), "_n", "left_semi").select("node").distinct()
        ready = settled(left.join(waiting, "node", "left_anti").withColumn("wave", F.lit(wave)))
        done = ready if done is None else done.unionByName(ready)
        left = settled(left.join(ready.select("node"), "node", "left_anti"))
        if ready.isEmpty() or left.isEmpty():
            break
        wave += 1
        if wave % 10 == 0:
            done = settled(done)
    return done.unionByName(left.withColumn("wave", F.lit(None).cast("int")))


def superseded(df: DataFrame, scope: list[str], at: str, filing: str, restates: Column) -> DataFrame:
    """Adds ``superseded``: whether a later restatement of the same scope, by (at, filing), replaces the row's filing.

    A filing whose rows differ in time or in being a restatement raises.
    """
    one = df.groupBy(*scope, filing).agg(F.min(at).alias("_at"), F.max(at).alias("_hi"), F.min(restates).alias("_is"), F.max(restates).alias("_any"))
    bad = (F.col("_at") != F.col("_hi")) | (F.col("_is") != F.col("_any"))
    one = one.withColumn("_is", F.when(bad, F.raise_error(F.lit("inconsistent filing metadata")).cast("boolean")).otherwise(F.col("_is")))
    last = F.max(F.when(F.col("_is"), F.struct(F.col("_at").alias("t"), F.col(filing).alias("f")))).over(Window.partitionBy(*scope))
    state = F.coalesce(F.struct(F.col("_at").alias("t"), F.col(filing).alias("f")) < last, F.lit(False))
    return df.join(one.withColumn("superseded", state).select(*scope, filing, "superseded"), [*scope, filing])
