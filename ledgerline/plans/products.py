"""Composite products: rankings, risk signals, execution chains, flows, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checks import union_all


def ranked(df: DataFrame, measure: str, key: str, name: str = "rank", cells: int = 256) -> DataFrame:
    """Adds the place by measure (largest first, ties by key) without sorting all rows in one task.

    Rows fall into cells between approximate quantiles; a cell's places follow
    from its own sort and from how many rows lie above.  The cuts may be
    approximate, the ranks are exact.
    """
    share = [i / cells for i in range(1, cells)]
    cuts = df.agg(F.percentile_approx(F.col(measure).cast("double"), share, 10_000).alias("_cuts"))
    # the number of cuts above a value: equal values share a cell
    cell = F.size(F.filter(F.array_distinct("_cuts"), lambda c: c > F.col(measure).cast("double")))
    placed = df.join(F.broadcast(cuts), F.lit(True)).withColumn("_cell", F.coalesce(cell, F.lit(0))).drop("_cuts")
    n = placed.groupBy("_cell").agg(F.count("*").alias("_n"))  # at most ``cells`` rows
    above = n.select("_cell", F.coalesce(F.sum("_n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(F.desc_nulls_last(measure), key))
    return placed.withColumn("_in", inside).join(F.broadcast(above), "_cell").withColumn(name, F.col("_above") + F.col("_in")).drop("_cell", "_in", "_above")


def page(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """Some rows in order, each with the number of all rows."""
    total = df.agg(F.count("*").alias("total"))
    return df.orderBy(*order).offset(offset).limit(limit).join(F.broadcast(total), F.lit(True))


# Weight of each family of risk signals, and of each severity.
FAMILIES = {"concentration": 1.0, "repeat_awards": 0.7, "subaward_opacity": 0.8, "parent_sub_mismatch": 1.0, "political_overlap": 0.6, "bond_contract_overlap": 0.5, "geographic_clustering": 0.4, "stale_lineage": 0.3}
SEVERITIES = {"high": 1.0, "medium": 0.6, "low": 0.3}
SIGNAL_COLUMNS = ["family", "subject_type", "subject", "severity", "confidence", "value"]


def signal_weight(c: str, table: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.col(c))


def subject_scores(all_signals: DataFrame, subject_types: list[str], divisor: float, with_confidence: bool = True, *more: Column) -> DataFrame:
    """subject, score (0 to 1), n_signals and the dominant family: that of most weight among those present (ties by name); more aggregates."""
    part = signal_weight("family", FAMILIES) * signal_weight("severity", SEVERITIES)
    if with_confidence:
        part = part * F.col("confidence")
    weighed = all_signals.filter(F.col("subject_type").isin(subject_types)).withColumns({"w": part, "_f": -signal_weight("family", FAMILIES)})
    score = F.least(F.lit(1.0), F.round(F.round(F.sum("w") / divisor, 9), 4))
    return weighed.groupBy("subject").agg(
        score.alias("score"), F.count("*").alias("n_signals"), F.min_by("family", F.struct("_f", "family")).alias("dominant_family"), *more
    )


def chain_scores(chains: DataFrame, all_signals: DataFrame, chain: str) -> DataFrame:
    """All chains with score (0 to 1), n_signals and opacity_flag; a chain without signals scores 0."""
    of_chains = all_signals.filter("subject_type = 'chain'")
    scored = subject_scores(of_chains, ["chain"], 3.0, with_confidence=False).drop("dominant_family")
    opaque = of_chains.groupBy("subject").agg(F.max(F.col("family") == "subaward_opacity").alias("opacity_flag"))
    both = scored.join(opaque, "subject").withColumnRenamed("subject", chain)
    return chains.join(both, chain, "left").fillna({"score": 0.0, "n_signals": 0, "opacity_flag": False})


def place_scores(awards: DataFrame, all_signals: DataFrame, place: str, amount: str, recipient: str) -> DataFrame:
    """place, awards, total, top_recipient (most awards, ties by name), score, n_signals: places with awards, with signals, or both."""
    by_recipient = awards.filter(F.trim(F.col(place).cast("string")) != "").groupBy(F.col(place).cast("string").alias("place"), F.col(recipient).alias("_who"))
    counted = by_recipient.agg(F.count("*").alias("_n"), F.sum(amount).alias("_sum"))
    stats = counted.groupBy("place").agg(
        F.sum("_n").alias("awards"), F.round(F.sum("_sum"), 2).alias("total"), F.min_by("_who", F.struct(-F.col("_n"), "_who")).alias("top_recipient")
    )
    scored = subject_scores(all_signals, ["municipality"], 2.0, with_confidence=False).drop("dominant_family").withColumnRenamed("subject", "place")
    return stats.join(scored, "place", "full_outer").fillna(0, ["awards", "total", "score", "n_signals"])


# Names that stand for nobody.
PLACEHOLDERS = (
    "NONE", "YES", "NO", "N/A", "NA", "UNKNOWN", "RETIRED", "SELF EMPLOYED", "SELF-EMPLOYED", "INDEPENDENT CONTRACTOR",
)


def quarantine(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rows whose name is a placeholder, in any case and spacing; blank names are kept."""
    bad = F.upper(F.trim(F.regexp_replace(F.coalesce(F.col(name), F.lit("")), r"\s+", " "))).isin(*PLACEHOLDERS)
    return df.filter(~bad), df.filter(bad)


def split_review(df: DataFrame, confidence: str, least: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Linked rows and the review queue; together they are all rows."""
    sure = F.coalesce(F.col(confidence) >= least, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def chain_rollup(chains: DataFrame, place: str, amount: str) -> DataFrame:
    """Per place: chains, distinct entities, obligation, share needing review."""
    return chains.groupBy(F.coalesce(F.nullif(F.trim(F.col(place).cast("string")), F.lit("")), F.lit("UNKNOWN")).alias("place")).agg(
        F.count("*").alias("chains"),
        F.count_distinct("prime").alias("primes"),
        F.count_distinct("sub").alias("subs"),
        F.round(F.sum(amount), 2).alias("obligation"),
        F.round(F.avg(F.col("review").cast("int")), 4).alias("review_rate"),
    )


def flows(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Typed flows in one schema with content-hash ids: (flow_type, amount_type) -> source, target, amount, day."""
    out = []
    for (kind, amount_kind), df in frames.items():
        payload = F.concat_ws("|", F.lit(kind), F.col("source").cast("string"), F.col("target").cast("string"), F.date_format("day", "yyyy-MM-dd"), "record")
        out.append(df.select(F.concat(F.lit("flow_"), F.substring(F.sha2(payload, 256), 1, 20)).alias("flow_id"), F.lit(kind).alias("flow_type"), F.lit(amount_kind).alias("amount_type"), F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target"), F.round("amount", 2).alias("amount"), F.col("day").cast("date").alias("day")))
    return union_all(out)


def with_source_row(df: DataFrame, number: str, name: str = "source_row") -> DataFrame:
    """Adds the line of a headed file that a row stood on (the first row: 2), from a numeric column that orders the rows."""
    return ranked(df.withColumn("_back", -F.col(number)), "_back", number, name).drop("_back").withColumn(name, F.col(name) + 1)


def top_share(df: DataFrame, key: str, amount: str, n: int = 10) -> DataFrame:
    """total, top_total, share: what the n keys of the largest sums have of all (ties by key)."""
    sums = df.groupBy(key).agg(F.sum(amount).alias("_x"))
    top = sums.orderBy(F.desc_nulls_last("_x"), key).limit(n).agg(F.sum("_x").alias("top_total"))
    both = sums.agg(F.sum("_x").alias("total")).join(F.broadcast(top), F.lit(True))  # one row each
    return both.select(F.round("total", 2).alias("total"), F.round("top_total", 2).alias("top_total"), F.round(F.col("top_total") / F.nullif("total", F.lit(0)), 6).alias("share"))


def summary_json(df: DataFrame, totals: dict[str, Column], by: list[str]) -> DataFrame:
    """summary: one JSON text of named totals and, for each column of ``by``, the rows of each of its values in order.

    Columns of ``by`` must have few values (datasets, years): their counts meet in one row.
    """
    out = df.agg(*[c.alias(name) for name, c in totals.items()])
    for c in by:
        n = df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("")).alias("k")).agg(F.count("*").alias("n"))
        counts = n.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(f"by_{c}"))
        out = out.join(F.broadcast(counts), F.lit(True))
    return out.select(F.to_json(F.struct(*totals, *[f"by_{c}" for c in by])).alias("summary"))
