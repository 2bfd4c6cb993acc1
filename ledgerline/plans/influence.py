"""The graph of influence: rows of any table become typed arcs by a declared projection.

A ``Projection`` says which columns name the two ends (the first filled one counts), the
verb, the types of the ends, and where weight, confidence and evidence come from.
``KINDS`` declares the row kinds that the library knows.  An arc without one of
its ends is left out.  Names are trimmed; nulls
count as empty; columns that a table lacks are empty.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from ..sources.interim import settled

# Columns that carry the same meaning in several tables, in order of trust.
NAMES = ("recipient_name", "vendor_name", "award_recipient_name", "prime_recipient_name")
IDS = ("recipient_uei", "uei", "entity_uei", "prime_uei")
PARENTS = ("parent_uei", "parent_name", "ultimate_parent_uei", "prime_parent_uei")
AMOUNTS = ("obligated_amount", "total_obligation", "obligation_amount", "subaward_amount", "amount")
AGENCIES = ("awarding_agency", "funding_agency", "funding_source", "awarding_sub_agency")
PLACES = ("municipality", "pop_county", "county", "pop_city")
AWARDS = ("award_id", "generated_unique_award_id", "prime_award_id")
# Verbs whose weight is money of contracts.
CONTRACT_VERBS = ("awards_to", "subawards_to", "underwrites", "funds_asset")
# Tiers of claims from best to worst.
TIERS = ("observed", "linked", "blocked")
REVIEW_BELOW = 0.8

_PRIME, _SUB, _ASSET = ("prime_parent_uei", "prime_name"), ("sub_parent_uei", "sub_name"), ("asset_id", "project_id")


@dataclass(frozen=True)
class Read:
    """Confidence from a column: divided, at most ``most``, ``blank`` where empty and ``unreadable`` where no number."""

    column: str
    divisor: float = 1.0
    most: float | None = None
    blank: float = 0.0
    unreadable: float = 0.0


@dataclass(frozen=True)
class Projection:
    """One arc of a row."""

    verb: str
    source: tuple[str, ...]
    target: tuple[str, ...]
    types: tuple[str, str]
    confidence: float | Read
    evidence: tuple[str, ...] = ()
    money: bool = False
    least_weight: bool = False  # no money counts as 1


@dataclass(frozen=True)
class Kind:
    """The arcs of a row, in the order in which their ends get their types; labels: (id, name, type) of nodes that rows introduce."""

    arcs: tuple[Projection, ...]
    labels: tuple[tuple[str, str, str], ...] = field(default=())


def _rating(unreadable: float) -> Read:
    return Read("confidence", 100.0, 0.95, 0.0, unreadable)


_LINK = Read("link_confidence", blank=0.5, unreadable=0.5)
_CHAIN = ("award_id", "subaward_id", "chain_id")
_ISSUE = ("cusip", "issue_id", "series")
# Kinds of rows with the verbs, types and confidences of their arcs.
KINDS = {
    "award": Kind((
        Projection("awards_to", AGENCIES, NAMES, ("agency", "prime"), 0.75, AWARDS, money=True),
        Projection("parent_of", (*PARENTS, "resolved_parent"), NAMES, ("parent_entity", "prime"), 0.90, AWARDS),
        Projection("located_in", NAMES, PLACES, ("prime", "municipality"), 0.60, AWARDS),
    )),
    "chain": Kind((
        Projection("subawards_to", _PRIME, _SUB, ("prime", "subcontractor"), _LINK, _CHAIN, money=True),
        Projection("executes_project", (*_SUB, *_PRIME), _ASSET, ("subcontractor", "asset"), _LINK, _CHAIN, money=True),
        Projection("located_in", (*_ASSET, *_SUB, *_PRIME), PLACES, ("asset", "municipality"), 0.60, _CHAIN),
    )),
    "lobbying": Kind((
        Projection("lobbies_for", ("registrant_name", "registrant"), ("client_name", "client"), ("lobbying_registrant", "lobbying_client"), 0.65, ("filing_uuid", "filing_id"), money=True, least_weight=True),
    )),
    "contribution": Kind((
        Projection("contributes_to", ("contributor_name", "donor", "name", "entity_name"), ("committee_name", "recipient_committee", "committee"), ("person_or_entity", "campaign_committee"), 0.55, ("transaction_id", "report_year"), money=True, least_weight=True),
    )),
    "bond": Kind((
        Projection("underwrites", ("issuer", "issuer_name"), ("underwriter", "dealer", "underwriter_name"), ("bond_issuer", "underwriter"), 0.80, _ISSUE, money=True),
        Projection("funds_asset", ("issuer", "issuer_name"), ("project_asset", *_ASSET), ("bond_issuer", "asset"), 0.65, _ISSUE, money=True),
    )),
    "ngo_funding": Kind((
        Projection("funds_ngo", ("source_entity", "funding_agency"), ("target_ngo_id",), ("agency", "ngo"), _rating(0.45), ("award_id", "edge_id"), money=True),
        Projection("located_in", ("target_ngo_id",), PLACES, ("ngo", "municipality"), 0.60, ("award_id", "edge_id")),
    ), (("target_ngo_id", "target_name", "ngo"),)),
    "ngo_asset": Kind((
        Projection("executes_project", ("ngo_id",), ("asset_id",), ("ngo", "asset"), _rating(0.55), ("asset_id",)),
        Projection("located_in", ("asset_id",), PLACES, ("asset", "municipality"), 0.60, ("asset_id",)),
    )),
    "ngo_sponsor": Kind((
        Projection("fiscal_sponsor_of", ("sponsor_ngo_id",), ("sponsored_entity",), ("ngo", "ngo"), _rating(0.70)),
    )),
}


def _text(df: DataFrame, c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in df.columns else F.lit("")


def first_filled(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """The first of the columns that is there and filled, else empty."""
    return F.coalesce(*[F.nullif(_text(df, c), F.lit("")) for c in columns if c in df.columns], F.lit(""))


def _number(df: DataFrame, c: str) -> Column:
    """The column as a number; what is a number already isn't written out and read again."""
    kind = dict(df.dtypes)[c]
    if kind in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind.startswith("decimal"):
        n = F.col(c).cast("double")
        return F.when(~F.isnan(n), n)
    return values.number(F.regexp_replace(_text(df, c), "[,$]", ""))


def _confidence(df: DataFrame, given: float | Read) -> Column:
    if not isinstance(given, Read):
        return F.lit(given)
    blank = F.lit(given.blank / given.divisor)
    if given.column not in df.columns:
        return blank
    is_text = dict(df.dtypes)[given.column] == "string"
    x = (values.number(_text(df, given.column)) if is_text else _number(df, given.column)) / given.divisor
    kept = F.least(x, F.lit(given.most)) if given.most is not None else x
    empty = _text(df, given.column) == "" if is_text else F.col(given.column).isNull()
    return F.when(empty, blank).when(x.isNull(), given.unreadable).otherwise(kept)


def _weight(df: DataFrame, arc: Projection) -> Column:
    if not arc.money:
        return F.lit(1.0)
    said = [_number(df, c) for c in AMOUNTS if c in df.columns]
    amount = F.coalesce(*said, F.lit(0.0))  # the first that can be read
    return F.when(amount == 0, 1.0).otherwise(amount) if arc.least_weight else amount


def with_parent(awards: DataFrame, entities: DataFrame, order: str) -> DataFrame:
    """Adds ``resolved_parent`` by id, else by name; entities: entity_uei, normalized_name, parent_uei, parent_name.

    Of several entities with a key the first in ``order`` counts, whether it has a parent or not.
    """
    parent = first_filled(entities, ("parent_uei", "parent_name"))
    keys = entities.select(F.explode(F.array_distinct(F.array(_text(entities, "entity_uei"), _text(entities, "normalized_name")))).alias("_k"), parent.alias("_p"), F.col(order).alias("_o"))
    index = keys.filter("_k <> ''").groupBy("_k").agg(F.min_by("_p", F.struct("_o", "_p")).alias("_p"))
    rows = awards.withColumns({"_id": first_filled(awards, IDS), "_name": first_filled(awards, NAMES)})
    for key, found in (("_id", "_by_id"), ("_name", "_by_name")):
        rows = rows.join(index.withColumnsRenamed({"_k": key, "_p": found}), key, "left")
    return rows.withColumn("resolved_parent", F.coalesce("_by_id", "_by_name", F.lit(""))).drop("_id", "_name", "_by_id", "_by_name")


def arcs(tables: list[tuple[str, str, DataFrame, str]], tiers: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Edges, and the labels that rows introduce; tables: (kind, dataset, rows, column of their order), in order.

    tiers: dataset -> tier of ``TIERS``; a dataset that isn't in it is blocked.  All arcs of
    a row come from one pass over it.
    """
    found, named = [], []
    for i, (kind, dataset, rows, order) in enumerate(tables):
        projections = KINDS[kind].arcs

        def of(make, projections=projections) -> Column:
            """The value for the arc at hand: made from the row's columns, so what nobody reads isn't made."""
            out = F
            for j, arc in enumerate(projections):
                out = out.when(F.col("_arc") == j, make(arc))
            return out

        tier = tiers.get(dataset, TIERS[-1])
        each = rows.withColumn("_arc", F.explode(F.array(*[F.lit(j) for j in range(len(projections))])))
        confidence = of(lambda arc, rows=rows: _confidence(rows, arc.confidence))
        ends = each.select(
            "*", of(lambda arc, rows=rows: first_filled(rows, arc.source)).alias("_source"), of(lambda arc, rows=rows: first_filled(rows, arc.target)).alias("_target"),
        ).filter("_source <> '' AND _target <> ''")
        found.append(ends.select(
            F.lit(i).alias("_table"), F.col(order).cast("long").alias("_row"), F.col("_source").alias("source"), F.col("_target").alias("target"), of(lambda arc: F.lit(arc.verb)).alias("verb"),
            of(lambda arc, rows=rows: F.round(_weight(rows, arc), 2)).alias("weight"), of(lambda arc, rows=rows: first_filled(rows, arc.evidence)).alias("evidence"), F.round(confidence, 3).alias("confidence"),
            (confidence < REVIEW_BELOW).alias("review"), of(lambda arc: F.lit(arc.types[0])).alias("source_type"), of(lambda arc: F.lit(arc.types[1])).alias("target_type"), "_arc",
            F.lit(dataset).alias("dataset"), F.lit(tier if tier in TIERS else TIERS[-1]).alias("tier"),
        ))
        for c, name, node_type in KINDS[kind].labels:
            said = rows.select(F.lit(i).alias("_table"), F.col(order).cast("long").alias("_row"), _text(rows, c).alias("node"), _text(rows, name).alias("label"), F.lit(node_type).alias("node_type"))
            named.append(said.filter("node <> '' AND label <> ''"))
    edges = reduce(lambda a, b: a.unionByName(b), found)
    schema = "_table int, _row long, node string, label string, node_type string"
    labels = reduce(lambda a, b: a.unionByName(b), named) if named else edges.sparkSession.createDataFrame([], schema)
    return edges, labels


def tallied(edges: DataFrame) -> DataFrame:
    """Of each node and each kind of end that it is: the first row, and what its metrics add up.

    A kind is a table, an arc of it and a side, so there are few rows for a node, and all
    that is kept of the arcs is numbers, which combine before they are shuffled.
    """
    rank = F.create_map(*[F.lit(x) for i, t in enumerate(TIERS) for x in (t, i)])
    side = lambda i, c: F.struct(F.lit(i).alias("_side"), F.col(c).alias("node"), F.col(f"{c}_type").alias("node_type"))
    each = edges.select("_table", "_row", "_arc", "weight", "review", F.col("verb").isin(*CONTRACT_VERBS).alias("_money"), rank[F.col("tier")].alias("_tier"), F.explode(F.array(side(0, "source"), side(1, "target"))).alias("e"))
    return each.groupBy("e.node", "e.node_type", "_table", "_arc", "e._side", "_money", "_tier").agg(
        F.min("_row").alias("_row"), F.count("*").alias("_n"), F.sum("weight").alias("_weight"), F.count_if("review").alias("_review")
    )


def _named(tally: DataFrame, labels: DataFrame) -> DataFrame:
    ends = tally.select("node", F.col("node").alias("label"), "node_type", "_table", "_row", "_arc", "_side")
    said = labels.groupBy("node", "label", "node_type", "_table").agg(F.min("_row").alias("_row"))
    every = ends.unionByName(said.withColumns({"_arc": F.lit(-1), "_side": F.lit(0)}))
    first = F.min_by(F.struct("label", "node_type"), F.struct("_table", "_row", "_arc", "_side", "label", "node_type"))
    return every.groupBy("node").agg(first.alias("f")).select("node", "f.*")


def _measured(tally: DataFrame, known: DataFrame) -> DataFrame:
    money = F.when(F.col("_money"), F.col("_weight")).otherwise(0.0)
    found = tally.groupBy("node").agg(
        F.sum("_n").alias("degree"), F.round(F.sum("_weight"), 2).alias("weighted_degree"), F.round(F.sum(money), 2).alias("contract_weight"),
        F.sum("_review").alias("review_edges"), F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.max("_tier") + 1).alias("tier"),
    )
    return found.join(known.select("node", "node_type"), "node")


def nodes(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """node, label, node_type: as the first row that names the node has it (a label of a row stands before its arcs)."""
    return _named(tallied(edges), labels)


def metrics(edges: DataFrame, known: DataFrame) -> DataFrame:
    """node, node_type, degree, weighted_degree, contract_weight, review_edges and the worst tier of its edges; a loop counts at both ends."""
    return _measured(tallied(edges), known)


def nodes_measured(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``metrics`` with the types of ``nodes``, from one pass over the arcs."""
    tally = settled(tallied(edges), "tally")
    return _measured(tally, _named(tally, labels))


def top_control(measured: DataFrame, n: int = 25) -> DataFrame:
    """The nodes with most contract money, ties by name."""
    return measured.orderBy(F.desc("contract_weight"), "node").limit(n)
