"""Entity resolution: which records are compared, how they match, and what is merged.

records: record, name (normalised), aliases (array), address, phone, officers (array), parent (a record),
contracts (array), clients (array), valid_from, valid_to, municipality, project, ids (map from kind to value).

Blocks.  A record has a key for each authoritative identifier, its name and aliases, its phone, its address and each long word of
its name.  All records that share a key are compared, so where a word is in most names the pairs are quadratic by nature: a
block is a grid of cells of at most ``CELL`` records a side, which bounds what a task holds.  A pair is made in the
first block, largest first, that both of its records have, so it comes up once without a distinct; a block whose records
all lie in one larger block makes none and is left out.

Only where a caller names a ``limit``, a wide key that more than so many records share is no evidence on its own and counts together
with another wide one; where two together are still wide, records are compared with the first of them only.
``wide_keys`` reports such keys.

Merges.  A merge needs an agreeing identifier, so only records that share one are compared for it (``merging``).  Pairs with an agreeing identifier and a score in the top band merge.  A merged group that holds two values of
one kind of identifier is wrong somewhere: the pairs of its records that lack that identifier, over which such
groups hang together, are taken out, kind by kind, and go to review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores, similarity
from ..operators import graph
from ..sources.interim import settled

# Kinds of identifiers that can justify a merge, strongest first.
AUTHORITATIVE = ["uei", "cage", "pr_corp_reg", "asg_licitador_id", "ein", "duns", "agency_code", "municipality_code"]
LIMIT, LONG = 200, 4
#: Records a side of a cell, at most; a block of over ``FEW`` records is cut further, into up to ``SIDE`` parts, so that many tasks share it.
CELL, FEW, SIDE = 20_000, 1_000, 16


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _entries(ids: Column) -> Column:
    """kind=value of the authoritative identifiers, sorted."""
    some = F.filter(F.map_entries(ids), lambda e: e["key"].isin(AUTHORITATIVE) & (F.coalesce(F.trim(e["value"]), F.lit("")) != ""))
    return F.coalesce(F.array_sort(F.transform(some, lambda e: F.concat_ws("=", e["key"], F.trim(e["value"])))), F.array().cast("array<string>"))


def keyed(records: DataFrame) -> DataFrame:
    """record, keys: the sorted keys of each record."""
    mark = lambda kind, values: F.transform(values, lambda v: F.concat(F.lit(kind + ":"), v))
    names = F.filter(F.concat(F.array(_filled(F.col("name"))), F.coalesce("aliases", F.array().cast("array<string>"))), lambda v: F.coalesce(F.trim(v), F.lit("")) != "")
    words = F.filter(similarity.tokens(F.col("name")), lambda w: F.length(w) >= LONG)
    one = lambda kind, c: F.filter(F.array(F.concat(F.lit(kind + ":"), _filled(F.col(c)))), lambda v: v.isNotNull())
    keys = F.concat(mark("id", _entries(F.col("ids"))), mark("name", names), mark("word", words), one("phone", "phone"), one("address", "address"))
    return records.select("record", F.array_sort(F.array_distinct(keys)).alias("keys"))


def _sizes(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("key").agg(F.count("*").alias("n"))


def wide_keys(records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """key, n: the keys that more than ``limit`` records share."""
    return _sizes(keyed(records).select("record", F.explode("keys").alias("key"))).filter(F.col("n") > limit)


def _ranked(each: DataFrame) -> DataFrame:
    """record, block, n of the keys that several records share; blocks have numbers, the largest first."""
    keys = _sizes(each).filter("n > 1").orderBy(F.desc("n"), "key").withColumn("block", F.monotonically_increasing_id())
    return settled(each.join(settled(keys, "key-sizes"), "key").select("record", "block", "n"), "keys")


def _crowded(each: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(record, block) and (record, block, first): the blocks whose records meet each other, and those whose records meet the first one.  each: record, block, n."""
    numbered = lambda df: df.withColumn("block", F.monotonically_increasing_id())  # noqa: E731  # written down, so each has it for good
    wide = F.col("n") > limit
    broad = settled(each.filter(wide).groupBy("record").agg(F.array_sort(F.collect_list("block")).alias("blocks")), "wide-keys")  # of one record
    two = F.flatten(F.transform("blocks", lambda x: F.transform(F.filter("blocks", lambda y: y > x), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    combined = broad.select("record", F.explode(two).alias("p")).select("record", "p.x", "p.y")
    sizes = settled(numbered(combined.groupBy("x", "y").agg(F.count("*").alias("n")).filter("n > 1").select("x", "y", (F.col("n") > limit).alias("still"))), "wide-pairs")
    combined = settled(combined.join(sizes, ["x", "y"]).select("record", (-1 - F.col("block")).alias("block"), "still"), "wide-pairs")
    blocks = each.filter(~wide).select("record", "block").unionByName(combined.filter("NOT still").select("record", "block"))
    crowd = combined.filter("still").select("record", "block")
    return blocks, crowd.join(crowd.groupBy("block").agg(F.min("record").alias("first")), "block")


def _met(records: DataFrame, fields: list[str], limit: int | None, keys: DataFrame | None = None) -> DataFrame:
    """a, b, _a, _b: the pairs to compare, each once and either way round, with the fields of both records; keys: record, keys, else those of ``keyed``.

    A record goes to each cell of its blocks once, with its fields; pairs are made there and never shuffled.
    """
    each = _ranked(settled((keyed(records) if keys is None else keys).select("record", F.explode("keys").alias("key")), "keys"))
    blocks, crowd = (each.select("record", "block"), None) if limit is None else _crowded(each, limit)
    own = settled(blocks.groupBy("record").agg(F.array_sort(F.collect_list("block")).alias("own")), "blocks")  # of one record
    # the pairs of a block are all made in another one where all of its records have that as their first
    sizes = blocks.join(own.select("record", F.col("own")[0].alias("first")), "record").groupBy("block").agg(F.count("*").alias("n"), F.min("first").alias("low"), F.max("first").alias("high"))
    sides = F.greatest(F.ceil(F.col("n") / CELL), F.least(F.ceil(F.col("n") / FEW), F.lit(SIDE))).cast("int")
    sizes = settled(sizes.filter("low < high OR low = block").select("block", sides.alias("side")), "blocks")
    full = settled(records.select("record", F.struct(*fields).alias("f")).join(own, "record", "left"), "blocks")
    placed = settled(blocks.join(sizes, "block").withColumn("at", F.pmod(F.xxhash64("record"), F.col("side")).cast("int")), "blocks")
    rows, cells = placed.count(), sizes.filter("side > 1").agg(F.sum(F.col("side") * (F.col("side") + 1) / 2)).first()[0]
    # so many parts that the records of one can be sorted in memory, and that cells of large blocks are spread
    parts = max(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + rows // 100_000, min(2 * int(cells or 0), 5_000))
    placed = placed.join(full, "record")
    # the upper half of the grid and its diagonal
    one = placed.withColumns({"row": F.col("at"), "column": F.explode(F.sequence("at", F.col("side") - 1))})
    other = placed.withColumns({"row": F.explode(F.sequence(F.lit(0), "at")), "column": F.col("at")})
    cell = ["block", "row", "column"]
    a, b = (df.select(*cell, F.col("record").alias(n), F.col("f").alias(f"_{n}"), F.col("own").alias(f"own_{n}")).repartition(parts, *cell) for df, n in ((one, "a"), (other, "b")))
    once = (F.col("row") < F.col("column")) | (F.col("a") < F.col("b"))
    x, y = F.col("own_a")[0], F.col("own_b")[0]
    here = F.when(x == y, x).otherwise(F.element_at(F.array_intersect("own_a", "own_b"), 1)) == F.col("block")
    met = a.join(b.hint("merge"), cell).filter(once & here).select("a", "b", "_a", "_b")
    if crowd is None:
        return met
    firsts = crowd.filter("record > first").groupBy("record").agg(F.collect_set("first").alias("firsts"))  # of one record
    star = full.join(firsts, "record").select(F.col("record").alias("b"), F.col("f").alias("_b"), F.col("own").alias("own_b"), F.explode("firsts").alias("a"))
    one = full.join(crowd.select(F.col("first").alias("record")).distinct(), "record", "left_semi")
    star = star.join(one.select(F.col("record").alias("a"), F.col("f").alias("_a"), F.col("own").alias("own_a")), "a")
    star = star.filter(~F.coalesce(F.arrays_overlap("own_a", "own_b"), F.lit(False)))
    return met.unionByName(star.select("a", "b", "_a", "_b"))


def _in_order(df: DataFrame) -> DataFrame:
    """a < b; what is said of a pair is the same either way round."""
    return df.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})


def pairs(records: DataFrame, limit: int | None = None) -> DataFrame:
    """a, b (a < b): the pairs of records to compare, each once."""
    return _in_order(_met(records, ["record"], limit).select("a", "b"))


FIELDS = ["_name", "_words", "aliases", "_place", "_phone", "officers", "parent", "contracts", "clients", "valid_from", "valid_to", "_municipality", "_project", "_ids", "_kinds"]


def _ready(records: DataFrame) -> DataFrame:
    """record, what its keys are made of and ``FIELDS``: all that can be said of a record on its own, once for each and not for each pair."""
    some = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    filled = lambda c: _filled(F.col(c).cast("string"))
    ready = records.withColumns({
        "_ids": _entries(F.col("ids")), "_name": F.col("name"), "_words": similarity.tokens(F.col("name")), "_place": similarity.tokens(F.col("address")), "_phone": filled("phone"),
        "_municipality": filled("municipality"), "_project": filled("project"), "aliases": some("aliases"), "contracts": some("contracts"), "clients": some("clients"),
    })
    return ready.withColumn("_kinds", F.transform("_ids", lambda e: F.substring_index(e, "=", 1))).select("record", "name", "address", "phone", "ids", *FIELDS)


def _decided(df: DataFrame) -> DataFrame:
    """a, b, the eleven features, shares_id, disagrees, score and decision of pairs; df: a, b, _a, _b (``FIELDS`` of either)."""
    x, y = F.col("_a"), F.col("_b")
    sure = lambda c: F.coalesce(c, F.lit(False))
    both = lambda c: F.size(F.array_intersect(x[c], y[c]))
    alike = lambda c: F.when((F.size(x[c]) > 0) & (F.size(y[c]) > 0), both(c) / (F.size(x[c]) + F.size(y[c]) - both(c))).otherwise(F.lit(0.0))  # noqa: E731  # Jaccard of distinct words
    shared = both("_ids")
    officers = F.size(F.array_intersect(x["officers"], y["officers"])) / F.greatest(F.least(F.size(x["officers"]), F.size(y["officers"])), F.lit(1))
    overlap = (F.coalesce(x["valid_from"], y["valid_to"]) <= y["valid_to"]) & (F.coalesce(y["valid_from"], x["valid_to"]) <= x["valid_to"])
    features = {
        "exact_id": F.col("shares_id"),
        "name": alike("_words"),
        "alias": sure(F.array_contains(y["aliases"], x["_name"]) | F.array_contains(x["aliases"], y["_name"])),
        "address": alike("_place"),
        "officer": F.coalesce(F.greatest(officers, F.lit(0.0)), F.lit(0.0)),
        "phone": sure(x["_phone"] == y["_phone"]),
        "parent": sure(x["parent"] == F.col("b")) | sure(y["parent"] == F.col("a")),
        "contract": sure(F.arrays_overlap(x["contracts"], y["contracts"])),
        "lobby": sure(F.arrays_overlap(x["clients"], y["clients"])),
        "municipality": sure(x["_municipality"] == y["_municipality"]) & sure(x["_project"] == y["_project"]),
        "temporal": sure(overlap),
    }
    df = df.withColumns({"shares_id": shared > 0, "disagrees": F.size(F.array_intersect(x["_kinds"], y["_kinds"])) > shared}).withColumns(features)
    df = df.withColumn("score", scores.match_score({k: F.col(k) for k in features}))
    df = df.withColumn("decision", scores.match_decision(F.col("score"), F.col("shares_id"), F.col("disagrees")))
    return df.select("a", "b", *features, "shares_id", "disagrees", "score", "decision")


def compared(records: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, the eleven features, shares_id, disagrees, score and decision of each pair."""
    ready = _ready(records)
    side = lambda n: ready.select(F.col("record").alias(n), F.struct(*FIELDS).alias(f"_{n}"))
    return _decided(found.join(side("a"), "a").join(side("b"), "b"))


def decisions(records: DataFrame, limit: int | None = None) -> DataFrame:
    """a, b, features, score and decision of all pairs that share a key."""
    records = settled(records, "records")
    return _in_order(_decided(_met(_ready(records), FIELDS, limit)))


def merging(records: DataFrame) -> DataFrame:
    """a, b: the pairs of ``decisions`` that merge.  None does without a shared identifier, so only records that share one are compared."""
    ready = _ready(settled(records, "records"))
    found = _decided(_met(ready, FIELDS, None, ready.select("record", F.array_distinct("_ids").alias("keys"))))
    return _in_order(found.filter("shares_id AND NOT disagrees AND decision = 'auto_merge'").select("a", "b", "decision"))


def merged(records: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(record, entity) and (a, b, kind): what each record is merged into (the smallest record), and the merges held back.

    No entity holds two values of an authoritative identifier.
    """
    links = settled(decided.filter("decision = 'auto_merge'").select("a", "b"), "merges")
    values = settled(records.select("record", F.explode(_entries(F.col("ids"))).alias("e")).select("record", F.substring_index("e", "=", 1).alias("kind"), "e"), "identifiers")
    there = {r.kind for r in values.select("kind").distinct().collect()}  # of the fixed kinds
    groups = lambda: settled(graph.components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "merge-groups")
    held, group = None, groups()
    for kind in AUTHORITATIVE:
        if kind not in there:
            continue
        one = values.filter(F.col("kind") == kind).select("record", "e")
        bad = group.join(one, F.col("node") == F.col("record")).groupBy("component").agg(F.count_distinct("e").alias("n")).filter("n > 1").select("component")
        bad = settled(bad, "merge-groups")
        if bad.isEmpty():
            continue
        inside = links.join(group.select(F.col("node").alias("a"), "component"), "a").join(bad, "component", "left_semi").select("a", "b")
        v = one.select(F.col("record").alias("a"), F.col("e").alias("v")), one.select(F.col("record").alias("b"), F.col("e").alias("w"))
        out = settled(inside.join(v[0], "a", "left").join(v[1], "b", "left").filter("NOT coalesce(v = w, false)").select("a", "b", F.lit(kind).alias("kind")), "held")
        links = settled(links.join(out, ["a", "b"], "left_anti"), "merges")
        held, group = out if held is None else held.unionByName(out), groups()
    group = group.select(F.col("node").alias("record"), F.col("component").alias("entity"))
    entities = records.select("record").distinct().join(group, "record", "left").withColumn("entity", F.coalesce("entity", "record"))
    return entities, held if held is not None else links.limit(0).withColumn("kind", F.lit(None).cast("string"))
