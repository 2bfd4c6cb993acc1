"""Risk signals: eight families of detectors over awards, chains, filings and bonds.

Each signal has a stable id, the rows it rests on, and a sentence that explains it.
awards: award_id, recipient, amount, place and the columns of ``LINEAGE``.
chains: chain_id, prime_name, sub_name, sub_uei, link_confidence, manual_review,
prime_parent, sub_parent.  Nulls count as empty texts and amounts as 0; an empty
table gives no signals.  Equal input rows give equal signals, with equal ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates
from ..operators.checks import union_all
from . import products

# Thresholds of the detectors.
SHARE, HIGH_SHARE = 0.15, 0.40
REPEATS = 3
LINK_CONFIDENCE = 0.80
PLACE_SHARE = 0.30
LINEAGE = ("source_lineage_path", "source_dataset", "source_record_id")
# What is taken out of a name, in this order, wherever it stands.
NAME_PARTS = (" LLC", " INC", " CORP", " LTD", " L.L.C.", " INC.", " CO.", " S.E.")
# Filing -> (type of signal, severity, confidence, whether the amount is the value).
FILINGS = {
    "lda": ("lobbying_client_is_awardee", "medium", 0.80, False),
    "cabilderos": ("pr_lobbying_client_is_awardee", "medium", 0.80, False),
    "fec": ("fec_contributor_employer_is_awardee", "low", 0.60, True),
}

COLUMNS = [
    "signal_id", "family", "kind", "severity", "subject_type", "subject", "entity", "value", "threshold", "confidence", "evidence", "explanation",
]


def bare_name(c: Column | str) -> Column:
    """A name as the detectors compare it: punctuation that belongs to no legal form stays."""
    s = F.trim(F.upper(text.text(c)))
    for p in NAME_PARTS:
        s = F.replace(s, F.lit(p), F.lit(""))
    return text.squeeze(s)


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _blank(c: str) -> Column:
    return F.trim(_filled(c)) == ""


def _amount(c: str | Column) -> Column:
    return F.format_number(F.round(c).cast("long"), 0)


def _percent(c: str) -> Column:
    return F.concat(F.format_number(F.round(F.col(c) * 100, 1), 1), F.lit("%"))


def _signal(rows: DataFrame, family: str, kind: str, subject_type: str, **columns: Column | str | float) -> DataFrame:
    """Rows of one detector in the shared schema."""
    given = {k: v if isinstance(v, Column) else F.lit(v) for k, v in columns.items()}
    given |= {"family": F.lit(family), "kind": F.lit(kind), "subject_type": F.lit(subject_type)}
    given["signal_id"] = F.concat(F.lit(f"SIG-{family[:4].upper()}-"), text.hashed(F.concat_ws("|", F.lit(kind), given["subject"], given["evidence"]), 16))
    numbers = {"value", "threshold", "confidence"}
    return rows.select(*[(given[c].cast("double") if c in numbers else given[c]).alias(c) for c in COLUMNS])


def _plain(awards: DataFrame) -> DataFrame:
    return awards.select("award_id", _filled("recipient").alias("recipient"), F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"), _filled("place").alias("place"))


def concentration(awards: DataFrame) -> DataFrame:
    """Recipients with a large share of all money.  At most 1 / ``SHARE`` pass, so they are broadcast to find their awards."""
    rows = _plain(awards)
    sums = rows.groupBy("recipient").agg(F.sum("amount").alias("sum"))
    total = rows.agg(F.sum("amount").alias("total"))
    large = sums.join(F.broadcast(total), F.lit(True)).withColumn("share", F.col("sum") / F.col("total")).filter(f"total > 0 AND share >= {SHARE}")
    ids = aggregates.top_ids(rows.join(F.broadcast(large.select("recipient")), "recipient"), ["recipient"], [F.col("award_id")], "award_id", 15, ";")
    said = F.concat("recipient", F.lit(" received "), _percent("share"), F.lit(" of all award money ("), _amount("sum"), F.lit(" of "), _amount("total"), F.lit(")"))
    return _signal(
        large.join(ids, "recipient"), "concentration", "entity_award_concentration", "entity",
        severity=F.when(F.col("share") >= HIGH_SHARE, "high").otherwise("medium"), subject=bare_name("recipient"), entity=F.col("recipient"),
        value=F.round("share", 6), threshold=SHARE, confidence=0.90, evidence=F.col("evidence"), explanation=said,
    )


def repeat_awards(awards: DataFrame) -> DataFrame:
    """Recipients of several awards."""
    rows = _plain(awards)
    n = rows.groupBy("recipient").agg(F.count("*").alias("n")).filter(F.col("n") >= REPEATS)
    found = n.join(aggregates.top_ids(rows, ["recipient"], [F.col("award_id")], "award_id", 15, ";"), "recipient")
    return _signal(
        found, "repeat_awards", "repeat_award_recipient", "entity", severity="medium", subject=bare_name("recipient"), entity=F.col("recipient"),
        value=F.col("n"), threshold=REPEATS, confidence=0.85, evidence=F.col("evidence"),
        explanation=F.concat("recipient", F.lit(" received "), F.col("n").cast("string"), F.lit(" awards")),
    )


def subaward_opacity(chains: DataFrame) -> DataFrame:
    """Chains whose subrecipient has no id, whose link is weak (missing or unreadable: sure) or that wait for review."""
    link = F.coalesce(F.col("link_confidence").try_cast("double"), F.lit(1.0))
    waits = F.lower(_filled("manual_review")).isin("true", "1", "yes")
    flags = F.concat_ws(
        ", ",
        F.when(_blank("sub_uei"), "missing_sub_uei"),
        F.when(F.col("link") < LINK_CONFIDENCE, F.concat(F.lit("low_link_confidence:"), F.format_number("link", 2))),
        F.when(waits, "manual_review_required"),
    )
    rows = chains.withColumn("link", link).withColumn("flags", flags).filter("flags <> ''")
    said = F.concat(F.lit("chain "), _filled("chain_id"), F.lit(" ("), _filled("prime_name"), F.lit(" to "), _filled("sub_name"), F.lit("): "), F.col("flags"))
    return _signal(
        rows, "subaward_opacity", "chain_opacity", "chain", severity=F.when(_blank("sub_uei"), "high").otherwise("medium"), subject=_filled("chain_id"),
        entity=_filled("prime_name"), value=F.col("link"), threshold=LINK_CONFIDENCE, confidence=F.greatest(F.lit(0.1), F.col("link")),
        evidence=_filled("chain_id"), explanation=said,
    )


def parent_sub_mismatch(chains: DataFrame) -> DataFrame:
    """Chains whose two ends have the same parent."""
    same = chains.filter(~_blank("prime_parent") & (F.trim(_filled("prime_parent")) == F.trim(_filled("sub_parent"))))
    return _signal(
        same, "parent_sub_mismatch", "shared_corporate_parent", "chain", severity="high", subject=_filled("chain_id"), entity=_filled("prime_name"),
        value=1.0, threshold=0.0, confidence=0.95, evidence=_filled("chain_id"),
        explanation=F.concat(_filled("prime_name"), F.lit(" and "), _filled("sub_name"), F.lit(" share the parent "), F.trim("prime_parent")),
    )


def awarded(awards: DataFrame, most: int = 5) -> DataFrame:
    """subject and its first award ids: one row for each compared name that isn't empty."""
    rows = awards.select("award_id", bare_name("recipient").alias("subject")).filter("subject <> ''")
    return aggregates.top_ids(rows, ["subject"], [F.col("award_id")], "award_id", most, ";").withColumnRenamed("evidence", "award_ids")


def political_overlap(awards: DataFrame, filings: dict[str, DataFrame]) -> DataFrame:
    """Filings whose client (or employer) also got awards; filings: keys of ``FILINGS``, each with client, record, by, amount."""
    known, found = awarded(awards), []
    for tag, (kind, severity, confidence, by_amount) in FILINGS.items():
        if tag not in filings:
            continue
        rows = filings[tag].withColumn("subject", bare_name("client")).join(known, "subject")
        found.append(
            _signal(
                rows, "political_overlap", kind, "entity", severity=severity, subject=F.col("subject"), entity=F.col("client"),
                value=F.coalesce(F.col("amount").cast("double"), F.lit(0.0)) if by_amount else 1.0, threshold=0.0, confidence=confidence,
                evidence=F.concat(F.lit(f"{tag}:"), _filled("record"), F.lit(";awards:"), F.col("award_ids")),
                explanation=F.concat("client", F.lit(f" is in {tag} ("), _filled("by"), F.lit(") and received awards")),
            )
        )
    return union_all(found)


def bond_contract_overlap(awards: DataFrame, bonds: DataFrame) -> DataFrame:
    """Bonds whose issuer also got awards; bonds: issuer, cusip, par."""
    par = F.coalesce(F.col("par").cast("double"), F.lit(0.0))
    rows = bonds.withColumn("par", par).withColumn("subject", bare_name("issuer")).join(awarded(awards), "subject")
    return _signal(
        rows, "bond_contract_overlap", "bond_issuer_is_contract_recipient", "entity", severity="medium", subject=F.col("subject"), entity=F.col("issuer"),
        value=F.col("par"), threshold=0.0, confidence=0.85,
        evidence=F.concat(F.lit("emma:"), _filled("cusip"), F.lit(";awards:"), F.col("award_ids")),
        explanation=F.concat("issuer", F.lit(" issued bond "), _filled("cusip"), F.lit(" ("), _amount("par"), F.lit(" par) and received awards")),
    )


def geographic_clustering(awards: DataFrame) -> DataFrame:
    """Places with a large share of all awards, those without a place among the whole.  At most 1 / ``PLACE_SHARE`` pass and are broadcast."""
    rows = _plain(awards)
    total = rows.agg(F.count("*").alias("total"))
    n = rows.filter("place <> ''").groupBy("place").agg(F.count("*").alias("n"))
    large = n.join(F.broadcast(total), F.lit(True)).withColumn("share", F.col("n") / F.col("total")).filter(F.col("share") >= PLACE_SHARE)
    inside = rows.join(F.broadcast(large.select("place")), "place")
    ids = aggregates.top_ids(inside, ["place"], [F.col("award_id")], "award_id", 10, ";")
    often = inside.groupBy("place", "recipient").agg(F.count("*").alias("k"))
    who = aggregates.top_ids(often, ["place"], [F.desc("k"), F.col("recipient")], "recipient", 2, ", ").withColumnRenamed("evidence", "who")
    said = F.concat("place", F.lit(" has "), _percent("share"), F.lit(" of the awards ("), F.col("n").cast("string"), F.lit(" of "), F.col("total").cast("string"), F.lit("), most to "), F.col("who"))
    return _signal(
        large.join(ids, "place").join(who, "place"), "geographic_clustering", "municipality_award_concentration", "municipality", severity="medium",
        subject=F.col("place"), entity=F.col("place"), value=F.round("share", 6), threshold=PLACE_SHARE, confidence=0.80,
        evidence=F.col("evidence"), explanation=said,
    )


def stale_lineage(awards: DataFrame) -> DataFrame:
    """Awards that don't say where they come from."""
    missing = [F.when(_blank(c), c) for c in LINEAGE]
    rows = awards.withColumn("missing", F.array_compact(F.array(*missing))).filter(F.size("missing") > 0)
    return _signal(
        rows, "stale_lineage", "missing_lineage_fields", "award", severity="low", subject=_filled("award_id"), entity=_filled("recipient"),
        value=F.size("missing"), threshold=0.0, confidence=0.70, evidence=_filled("award_id"),
        explanation=F.concat(F.lit("award "), _filled("award_id"), F.lit(" lacks "), F.array_join("missing", ", ")),
    )


def detect(awards: DataFrame, chains: DataFrame, filings: dict[str, DataFrame], bonds: DataFrame) -> DataFrame:
    """All signals."""
    found = [concentration(awards), repeat_awards(awards), subaward_opacity(chains), parent_sub_mismatch(chains)]
    return union_all([*found, political_overlap(awards, filings), bond_contract_overlap(awards, bonds), geographic_clustering(awards), stale_lineage(awards)])


def entity_scores(signals: DataFrame) -> DataFrame:
    """Scores of entities and chains, with name (of the first family in the order of ``products.FAMILIES``), families and mean confidence."""
    place = products.signal_weight("family", {f: float(i) for i, f in enumerate(products.FAMILIES)})
    return products.subject_scores(
        signals, ["entity", "chain"], len(products.FAMILIES), True,
        F.min_by("entity", F.struct(place, "entity")).alias("entity"),
        F.array_join(F.sort_array(F.collect_set("family")), ";").alias("families"),
        F.round(F.round(F.avg("confidence"), 9), 4).alias("confidence"),
    )


def fired(signals: DataFrame) -> DataFrame:
    """family, signals, subjects: what a report counts."""
    return signals.groupBy("family").agg(F.count("*").alias("signals"), F.count_distinct("subject").alias("subjects"))
