"""The graph of political money: four relations between donors, committees, recipients and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores, text
from ..operators.checks import union_all

# Where rows come from; a node is named by the first source that has it.
SOURCES = ("fec_committees", "fec_schedule_a", "oce", "cee", "fec_schedule_b", "fec_schedule_e")


def stable_id(prefix: str, *names: Column | str) -> Column:
    """prefix and 20 hex digits of the normalised names."""
    return F.concat(F.lit(prefix + "_"), text.hashed(F.concat_ws("|", *[text.graph_name(n) for n in names]), 20))


def _committee(number: str, name: Column) -> Column:
    filled = F.nullif(F.trim(text.text(number)), F.lit(""))
    return F.coalesce(F.concat(F.lit("fec_committee:"), filled), stable_id("committee", name))


def _node(rows: DataFrame, source: str, side: int, node: Column, kind: Column | str, name: Column | str, confidence: Column | float) -> DataFrame:
    place = F.struct(F.lit(SOURCES.index(source)).alias("s"), F.col("n"), F.lit(side).alias("side"))
    as_column = lambda c: c if isinstance(c, Column) else F.lit(c)
    return rows.select(
        node.alias("entity_id"), as_column(kind).alias("entity_type"), F.trim(text.text(name)).alias("canonical_name"),
        F.lit(source).alias("source_id"), F.col("record").alias("source_record_id"), as_column(confidence).cast("double").alias("confidence"), place.alias("place"),
    )


def _edge(rows: DataFrame, source: str, a: Column, b: Column, kind: Column | str, confidence: Column | float, stance: Column | None = None) -> DataFrame:
    rows = rows.withColumns({"source_entity_id": a, "target_entity_id": b, "edge_type": kind if isinstance(kind, Column) else F.lit(kind)})
    return rows.select(
        stable_id("pfe", F.lit(source), F.col("record"), "source_entity_id", "target_entity_id", "edge_type").alias("edge_id"),
        "source_entity_id", "target_entity_id", "edge_type", "amount", "day",
        (F.lit("") if stance is None else stance).alias("support_oppose"), F.lit(source).alias("source_id"),
        F.col("record").alias("source_record_id"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).cast("double").alias("confidence"), "n",
    )


def resolved(payments: DataFrame, index: DataFrame) -> DataFrame:
    """payments with entity_id, entity_name, method and confidence of the only entity of their recipient's name.

    index: name, entity_id, entity_name, method, confidence.  Names of several
    entities resolve to none; what isn't resolved has method unresolved and 0.40.
    """
    best = F.struct("entity_id", "entity_name", "method", "confidence")
    names = index.groupBy(text.graph_name("name").alias("_name")).agg(F.min("entity_id").alias("_lo"), F.max("entity_id").alias("_hi"), F.min(best).alias("_best"))
    only = names.filter("_lo = _hi").select("_name", "_best.*")
    found = payments.withColumn("_name", text.graph_name("recipient")).join(only, "_name", "left").drop("_name")
    return found.fillna({"method": "unresolved", "confidence": 0.40})


def graph(committees: DataFrame, receipts: dict[str, DataFrame], payments: DataFrame, expenditures: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, edges and the resolutions of recipients.

    committees: committee_id, name, said (type words), code.  receipts by source: donor,
    committee_id, committee_name.  payments: committee_id, committee_name, recipient.
    expenditures: committee_id, committee_name, candidate_id, candidate_name, indicator.
    All have record and n (their order); all but committees amount and day.  An entity is
    described by its first row in order of source, n and side; an edge by its last.
    """
    number = F.coalesce(F.nullif(F.trim(text.text("committee_id")), F.lit("")), stable_id("committee", "name"))
    all_committees = committees.withColumn("record", number)
    nodes = [_node(all_committees, "fec_committees", 0, F.concat(F.lit("fec_committee:"), number), scores.committee_kind(text.graph_name("said"), F.upper(F.trim(text.text("code")))), "name", 1.0)]
    edges = []
    for source, rows in receipts.items():
        donor, target = stable_id("donor", "donor"), _committee("committee_id", F.col("committee_name"))
        nodes += [_node(rows, source, 0, donor, "DONOR", "donor", 0.90), _node(rows, source, 1, target, "POLITICAL_COMMITTEE", "committee_name", 0.85)]
        edges.append(_edge(rows, source, donor, target, "DONATED_TO", 0.95))
    payer = F.concat(F.lit("fec_committee:"), text.text("committee_id"))
    paid = resolved(payments, index)
    target = F.coalesce("entity_id", stable_id("unresolved_recipient", "recipient"))
    nodes += [_node(paid, "fec_schedule_b", 0, payer, "POLITICAL_COMMITTEE", "committee_name", 1.0), _node(paid, "fec_schedule_b", 1, target, "DOWNSTREAM_RECIPIENT", F.coalesce("entity_name", "recipient"), F.col("confidence"))]
    edges.append(_edge(paid, "fec_schedule_b", payer, target, "DISBURSED_TO", F.col("confidence")))
    candidate = F.concat(F.lit("fec_candidate:"), F.coalesce(F.nullif(text.text("candidate_id"), F.lit("")), text.text("candidate_name")))
    stance = text.graph_name("indicator")
    nodes += [_node(expenditures, "fec_schedule_e", 0, payer, "POLITICAL_COMMITTEE", "committee_name", 1.0), _node(expenditures, "fec_schedule_e", 1, candidate, "CANDIDATE", "candidate_name", 1.0)]
    kind = F.when(stance.startswith("O"), "INDEPENDENT_EXPENDITURE_AGAINST").otherwise("INDEPENDENT_EXPENDITURE_FOR")
    edges.append(_edge(expenditures, "fec_schedule_e", payer, candidate, kind, 1.0, stance))
    every_node, every_edge = union_all(nodes), union_all(edges)
    told = [c for c in every_node.columns if c not in ("entity_id", "place")]
    entities = every_node.groupBy("entity_id").agg(F.min_by(F.struct(*told), "place").alias("x")).select("entity_id", "x.*")
    said = [c for c in every_edge.columns if c not in ("edge_id", "n")]
    last = every_edge.groupBy("edge_id").agg(F.max_by(F.struct(*said), "n").alias("x")).select("edge_id", "x.*")
    resolutions = paid.select(
        F.lit("fec_schedule_b").alias("source_id"), F.col("record").alias("source_record_id"), F.col("recipient").alias("raw_recipient_name"),
        text.text("entity_id").alias("resolved_entity_id"), text.text("entity_name").alias("resolved_name"), F.col("method").alias("resolution_method"),
        "confidence", (F.col("method") == "unresolved").alias("review_required"),
    )
    return entities, last, resolutions
