"""A registry of sources in layers, and rule sets that tables hold.

Layers are JSON files under one folder: base.json and extensions/*.json define sources (``sources``: a list of objects with a
source_id), overrides/*.json change some of their fields (``source_overrides``).  Everything becomes one table with
a row for each source and field, so that an override wins field by field and every rule is a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores

#: Fields that an override may repeat but not change.
FIXED = ["source_id", "required"]
#: Rules that are compiled into an expression at most.
MOST_RULES = 2000
ENTRIES = "layer string, place string, source_id string, field string, value string"


def read_layers(spark: SparkSession, root: str) -> DataFrame:
    """layer (base, extension or override), place (file and number), source_id, field, value (text; lists and objects as JSON)."""
    found = None
    for layer, pattern, name in (("base", "base.json", "sources"), ("extension", "extensions/*.json", "sources"), ("override", "overrides/*.json", "source_overrides")):
        files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).text(root)
        inside = F.replace(F.input_file_name(), F.lit("%20"), F.lit(" "))
        files = files.withColumn("file", inside).filter(F.col("file").rlike("/" + pattern.replace(".", r"\.").replace("*", "[^/]*") + "$"))
        parsed = F.from_json("value", f"{name} array<map<string,string>>", {"mode": "FAILFAST"})[name]
        rows = files.select("file", F.posexplode(parsed).alias("nth", "entry"))
        place = F.concat_ws("#", "file", F.format_string("%06d", "nth"))
        each = rows.select(F.lit(layer).alias("layer"), place.alias("place"), F.trim(F.col("entry")["source_id"]).alias("source_id"), F.explode("entry").alias("field", "value"))
        found = each if found is None else found.unionByName(each)
    return found


def faults(entries: DataFrame) -> DataFrame:
    """place, source_id, fault: what keeps a registry from being merged."""
    objects = entries.select("layer", "place", "source_id").distinct()
    blank = F.coalesce(F.col("source_id"), F.lit("")) == ""
    made, changed = objects.filter("layer <> 'override' AND source_id <> ''"), objects.filter("layer = 'override' AND source_id <> ''")
    say = lambda df, what: df.select("place", "source_id", F.lit(what).alias("fault"))

    def again(df: DataFrame) -> DataFrame:
        first = df.groupBy("source_id").agg(F.min("place").alias("_first"))
        return df.join(first, "source_id").filter("place > _first")

    fields = entries.filter((F.col("layer") != "override") & F.col("field").isin(FIXED)).select("source_id", "field", F.col("value").alias("was"))
    fixed = entries.filter((F.col("layer") == "override") & F.col("field").isin(FIXED)).join(fields, ["source_id", "field"], "left")
    return (
        say(objects.filter(blank), "source_id missing")
        .unionByName(say(again(made), "duplicate source_id"))
        .unionByName(say(again(changed), "duplicate override"))
        .unionByName(say(changed.join(made.select("source_id").distinct(), "source_id", "left_anti"), "override of an unknown source"))
        .unionByName(say(fixed.filter("field <> 'source_id' AND NOT value <=> was").join(made.select("source_id").distinct(), "source_id", "left_semi"), "override of a fixed field"))
    )


def merged(entries: DataFrame, strict: bool = True) -> DataFrame:
    """source_id, field, value, layer: each field of each source from the layer that has the last word.

    strict: any fault raises, with the first few named; without it faulty overrides are left out, and of sources that repeat the
    first by place stays.
    """
    wrong = faults(entries)
    if strict:
        some = wrong.orderBy("place", "fault").limit(5).collect()
        if some:
            raise ValueError("registry: " + "; ".join(f"{r.source_id or r.place}: {r.fault}" for r in some))
    else:
        entries = entries.join(wrong.select("place").distinct(), "place", "left_anti")
    rank = F.when(F.col("layer") == "override", 0).when(F.col("layer") == "extension", 1).otherwise(2)
    best = entries.filter("source_id <> ''").groupBy("source_id", "field").agg(F.min_by(F.struct("value", "layer"), F.struct(rank, "place")).alias("e"))
    return best.select("source_id", "field", "e.value", "e.layer")


def wide(table: DataFrame, fields: list[str]) -> DataFrame:
    """A row for each source with the fields named; a field that no layer knows raises, so that a misspelt one isn't null."""
    known = {r.field for r in table.filter(F.col("field").isin(fields)).select("field").distinct().collect()}  # of those asked for
    if missing := [f for f in fields if f not in known]:
        raise ValueError(f"registry: no source has {', '.join(missing)}")
    return table.groupBy("source_id").pivot("field", fields).agg(F.first("value"))


def rule_words(rules: DataFrame) -> dict[str, tuple[str, ...]]:
    """label -> words in order, from rules: label, word, place; at most ``MOST_RULES`` (more raise: match them by a join, see ``labels_by_word``)."""
    rows = rules.select("label", "word", "place").filter("label IS NOT NULL AND word <> ''").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules can't be one expression")
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.place, r.label, r.word)):
        out.setdefault(r.label, []).append(r.word)
    return {k: tuple(dict.fromkeys(v)) for k, v in out.items()}


def routed(text: Column, rules: dict[str, tuple[str, ...]], canonical: list[str]) -> Column:
    """Struct of the labels whose words a text holds, sorted, and the route: canonical, derivative, or review without a label.

    A canonical label that has no rule raises.
    """
    if unknown := sorted(set(canonical) - set(rules)):
        raise ValueError(f"no rules for {', '.join(unknown)}")
    low = F.lower(F.coalesce(text, F.lit("")))
    labels = F.array_compact(F.array(*[F.when(scores.keyword_hits(low, w) > 0, F.lit(k)) for k, w in sorted(rules.items())]))
    route = F.when(F.size(labels) == 0, "review").when(F.arrays_overlap(labels, F.array(*[F.lit(c) for c in canonical])), "canonical").otherwise("derivative")
    return F.struct(labels.alias("labels"), route.alias("route"))


def labels_by_word(df: DataFrame, row: str, words: Column, rules: DataFrame) -> DataFrame:
    """row, labels (sorted): for rules of any number that are whole words, an equi-join on the distinct words of each text."""
    each = df.select(row, F.explode(F.array_distinct(words)).alias("word"))
    known = rules.select("label", "word").filter("label IS NOT NULL AND word <> ''").distinct()
    return each.join(known, "word").groupBy(row).agg(F.array_sort(F.collect_set("label")).alias("labels"))
