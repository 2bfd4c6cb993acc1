"""Organisation changes: what an event means, as expressions over its columns.

Columns of an event: change_event_id, affected_entity_id, event_type, status,
certification_state, confidence, evidence (array of evidence types), predecessors
and successors (arrays of entity ids), instrument_date, effective_date,
announcement_date, implementation_date, and arrays of what goes over: assets,
appropriations, contracts, personnel.  Columns that a table lacks are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import succession

# Event types by severity; any other known type is S0.
SEVERITY = {
    "S4": ["DISSOLUTION", "ABOLITION", "MERGER", "CONSOLIDATION", "SPLIT", "SUCCESSOR_CREATION", "PRIVATIZATION", "PPP_TRANSFER"],
    "S3": [
        "TRANSFER_OF_FUNCTIONS", "TRANSFER_OF_ASSETS", "TRANSFER_OF_LIABILITIES", "TRANSFER_OF_CONTRACTS", "TRANSFER_OF_APPROPRIATIONS",
        "LOSS_OF_STATUTORY_POWER", "GAIN_OF_STATUTORY_POWER", "PROCUREMENT_AUTHORITY_CHANGE", "BUDGET_AUTHORITY_CHANGE",
        "REGULATORY_AUTHORITY_CHANGE", "ENFORCEMENT_AUTHORITY_CHANGE", "LICENSING_AUTHORITY_CHANGE", "OVERSIGHT_CHANGE", "RECEIVERSHIP",
        "FISCAL_CONTROL", "CONCESSION", "SUNSET_EXPIRATION", "DEFUNDING",
    ],
    "S2": [
        "REORGANIZATION", "PARENT_CHANGE", "TRANSFER_OF_PERSONNEL", "MUNICIPALIZATION", "CENTRALIZATION", "DECENTRALIZATION",
        "TEMPORARY_EMERGENCY_AUTHORITY", "OPERATIONAL_SUSPENSION", "MATERIAL_BUDGET_REDUCTION", "MATERIAL_HEADCOUNT_REDUCTION",
    ],
    "S1": ["SUNSET_EXTENSION"],
    "S0": ["RENAMING"],
}
# Which graphs an event makes stale, beside those of entities and of continuity.
ALWAYS = ["ENTITY_GRAPH", "HISTORICAL_CONTINUITY_GRAPH"]
SCOPES = {
    "TRANSFER_OF_CONTRACTS": ["CONTRACT_GRAPH", "VENDOR_GRAPH"],
    "TRANSFER_OF_APPROPRIATIONS": ["APPROPRIATION_GRAPH", "GRANT_GRAPH"],
    "TRANSFER_OF_ASSETS": ["PROPERTY_AND_ASSET_GRAPH"],
    "TRANSFER_OF_PERSONNEL": ["PERSONNEL_GRAPH"],
    "PROCUREMENT_AUTHORITY_CHANGE": ["CONTRACT_GRAPH", "VENDOR_GRAPH"],
    "REGULATORY_AUTHORITY_CHANGE": ["REGULATORY_GRAPH"],
    "ENFORCEMENT_AUTHORITY_CHANGE": ["REGULATORY_GRAPH"],
    "LICENSING_AUTHORITY_CHANGE": ["REGULATORY_GRAPH"],
    "BUDGET_AUTHORITY_CHANGE": ["APPROPRIATION_GRAPH", "GRANT_GRAPH"],
}
ALL_SCOPES = [
    "APPROPRIATION_GRAPH", "CAMPAIGN_AND_LOBBYING_GRAPH", "CONTRACT_GRAPH", "ENTITY_GRAPH", "GRANT_GRAPH", "HISTORICAL_CONTINUITY_GRAPH",
    "PERSONNEL_GRAPH", "PPP_GRAPH", "PROPERTY_AND_ASSET_GRAPH", "REGULATORY_GRAPH", "VENDOR_GRAPH",
]
#: S4 and these make all graphs stale.
WIDE = ["TRANSFER_OF_FUNCTIONS", "FISCAL_CONTROL"]
CARRIED = {
    "contracts": ["CONTRACT_GRAPH", "VENDOR_GRAPH"],
    "appropriations": ["APPROPRIATION_GRAPH", "GRANT_GRAPH"],
    "assets": ["PROPERTY_AND_ASSET_GRAPH"],
    "personnel": ["PERSONNEL_GRAPH"],
}
MONEY_SCOPES = ["CONTRACT_GRAPH", "APPROPRIATION_GRAPH", "PROPERTY_AND_ASSET_GRAPH", "REGULATORY_GRAPH"]
# Kinds of events, and the evidence that binds them.
STRUCTURAL = ["DISSOLUTION", "ABOLITION", "MERGER", "CONSOLIDATION", "SPLIT", "SUCCESSOR_CREATION"]
OPERATIONAL = [
    "TRANSFER_OF_FUNCTIONS", "TRANSFER_OF_ASSETS", "TRANSFER_OF_LIABILITIES", "TRANSFER_OF_PERSONNEL", "TRANSFER_OF_CONTRACTS",
    "TRANSFER_OF_APPROPRIATIONS", "PROCUREMENT_AUTHORITY_CHANGE", "BUDGET_AUTHORITY_CHANGE", "REGULATORY_AUTHORITY_CHANGE",
    "ENFORCEMENT_AUTHORITY_CHANGE", "LICENSING_AUTHORITY_CHANGE", "OVERSIGHT_CHANGE", "CONCESSION", "PPP_TRANSFER",
]
SUCCESSION_EVIDENCE = [
    "ENACTED_LAW_OR_CONSTITUTION", "EXECUTIVE_ORDER_WITH_VALID_AUTHORITY", "REGULATION", "OFFICIAL_REORGANIZATION_PLAN", "OFFICIAL_GOVERNMENT_REGISTER",
]
LEGAL_EVIDENCE = [*SUCCESSION_EVIDENCE, "APPROPRIATIONS_ACT"]
OPERATIONAL_EVIDENCE = [*LEGAL_EVIDENCE, "PROCUREMENT_OR_CONTRACT_TRANSFER_RECORD", "OFFICIAL_ORGANIZATIONAL_CHART"]
EVIDENCE = [
    *OPERATIONAL_EVIDENCE, "AGENCY_OR_FISCAL_PLAN", "BUDGET_DOCUMENT", "AUTHORITATIVE_PRESS_RELEASE", "LEGISLATIVE_PROPOSAL", "NEWS_REPORT",
    "OTHER_SECONDARY_REPORT",
]
STATES = [
    "ACTIVE", "ACTIVE_RESTRUCTURING_PENDING", "AUTHORITY_REDUCED", "AUTHORITY_EXPANDED", "FUNCTIONS_PARTIALLY_TRANSFERRED",
    "FUNCTIONS_FULLY_TRANSFERRED", "MERGER_PENDING", "SUCCESSOR_PENDING", "DISSOLUTION_PENDING", "DISSOLVED", "SUPERSEDED",
    "TEMPORARILY_SUSPENDED", "UNKNOWN",
]
TERMINAL = ["DISSOLVED", "SUPERSEDED", "FUNCTIONS_FULLY_TRANSFERRED"]
CERTIFICATION = [
    "PASS", "FAIL", "OPEN", "BLOCKED", "PROVISIONAL", "AUDIT_ONLY", "NONCANONICAL", "CANDIDATE_NOT_IDENTITY", "UNRESOLVED", "SUPERSEDED",
]
_ARRAYS = ["evidence", "predecessors", "successors", *CARRIED]
_DATES = ["instrument_date", "effective_date", "announcement_date", "implementation_date"]


def _list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def severity(kind: Column) -> Column:
    """S0 to S4."""
    out = F.lit("S0")
    for level, kinds in reversed(SEVERITY.items()):
        out = F.when(kind.isin(kinds), level).otherwise(out)
    return out


def binding(kind: Column, evidence: Column, effective: Column) -> Column:
    """Whether evidence of the kind that the event needs stands behind an effective date."""
    needed = F.when(~kind.isin(STRUCTURAL) & kind.isin(OPERATIONAL), _list(OPERATIONAL_EVIDENCE)).otherwise(_list(LEGAL_EVIDENCE))
    return effective.isNotNull() & F.arrays_overlap(evidence, needed)


def timeline_state(status: Column, binds: Column) -> Column:
    """The event's state; a terminal one that nothing binds is UNKNOWN."""
    return F.when(~binds & status.isin(TERMINAL), "UNKNOWN").otherwise(status)


def scopes(kind: Column, carried: dict[str, Column]) -> Column:
    """The graphs that the event makes stale, sorted."""
    own = F.array().cast("array<string>")
    for name, more in SCOPES.items():
        own = F.when(kind == name, _list(more)).otherwise(own)
    parts = [own, _list(ALWAYS)]
    for name, more in CARRIED.items():
        parts.append(F.when(F.size(carried[name]) > 0, _list(more)).otherwise(F.array().cast("array<string>")))
    some = F.array_sort(F.array_distinct(F.concat(*parts)))
    return F.when(kind.isin([*SEVERITY["S4"], *WIDE]), _list(ALL_SCOPES)).otherwise(some)


def _ready(events: DataFrame) -> DataFrame:
    """The events with all columns of the contract; dates that can't be read are null here and a fault below."""
    have = set(events.columns)
    lists = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) if c in have else F.array().cast("array<string>") for c in _ARRAYS}
    dates = {c: F.col(c).cast("string") if c in have else F.lit(None).cast("string") for c in _DATES}
    return events.withColumns(lists | dates)


def fault(events: DataFrame) -> Column:
    """The first rule that an event breaks, or null.  Rules in order; the events are those of ``_ready``."""
    c = F.col
    blank = lambda x: F.coalesce(F.trim(c(x).cast("string")), F.lit("")) == ""
    day = lambda x: F.try_to_date(F.nullif(c(x), F.lit("")), "yyyy-MM-dd")
    unread = F.lit(False)
    for x in _DATES:
        unread = unread | ((F.coalesce(c(x), F.lit("")) != "") & day(x).isNull())
    ends = (F.size("predecessors") > 0) | (F.size("successors") > 0)
    twice = lambda x: F.size(c(x)) != F.size(F.array_distinct(c(x)))
    empty = lambda x: F.exists(c(x), lambda v: F.coalesce(F.trim(v), F.lit("")) == "")
    proposal = F.array_contains("evidence", "LEGISLATIVE_PROPOSAL") & ~F.arrays_overlap("evidence", _list(OPERATIONAL_EVIDENCE))
    sure = c("confidence").try_cast("double")
    kinds = [k for level in SEVERITY.values() for k in level]
    rules = [
        (blank("change_event_id") | blank("affected_entity_id"), "identity missing"),
        (~F.coalesce(c("event_type").isin(kinds), F.lit(False)), "unsupported event_type"),
        (~F.coalesce(c("status").isin(STATES), F.lit(False)), "unsupported status"),
        (~F.coalesce(c("certification_state").isin(CERTIFICATION), F.lit(False)), "unsupported certification_state"),
        (~F.coalesce(sure.between(0, 1), F.lit(False)), "confidence outside 0 to 1"),
        (twice("predecessors") | twice("successors"), "entity named twice"),
        (empty("predecessors") | empty("successors"), "empty entity id"),
        (unread, "unreadable date"),
        (day("effective_date") < day("instrument_date"), "effective before instrument"),
        (day("implementation_date") < day("announcement_date"), "implemented before announced"),
        ((F.size("evidence") == 0) | F.exists("evidence", lambda e: ~F.coalesce(e.isin(EVIDENCE), F.lit(False))), "evidence missing or unknown"),
        (ends & ~F.arrays_overlap("evidence", _list(SUCCESSION_EVIDENCE)), "succession without authority"),
        (proposal & (day("effective_date").isNotNull() | c("status").isin(TERMINAL)), "proposal can't bind"),
        ((c("event_type") == "RENAMING") & ends, "renaming isn't succession"),
    ]
    out = None
    for broken, said in rules:
        broken = F.coalesce(broken, F.lit(False))
        out = F.when(broken, said) if out is None else out.when(broken, said)
    return out


def evaluated(events: DataFrame) -> DataFrame:
    """events with fault and, where there is none, severity, binding, timeline_state, cardinality, scopes, reasons and alert."""
    df = _ready(events)
    df = df.withColumn("fault", fault(df))
    kind = F.col("event_type")
    effective = F.nullif(F.col("effective_date"), F.lit(""))
    df = df.withColumns(
        {
            "severity": severity(kind),
            "binding": binding(kind, F.col("evidence"), effective),
            "cardinality": succession(F.col("predecessors"), F.col("successors")),
            "scopes": scopes(kind, {c: F.col(c) for c in CARRIED}),
        }
    )
    ends = (F.size("predecessors") > 0) | (F.size("successors") > 0)
    said = [
        (F.col("severity").isin("S3", "S4"), "MAJOR_OR_STRUCTURAL_CHANGE"),
        (F.arrays_overlap("scopes", _list(MONEY_SCOPES)), "MONEY_OR_CONTROL_EDGE_RECOMPUTE"),
        (kind == "PARENT_CHANGE", "ENTITY_HIERARCHY_RECOMPUTE"),
        (ends, "SUCCESSION_RECOMPUTE"),
        ((F.col("cardinality") == "UNRESOLVED") & kind.isin(STRUCTURAL), "SUCCESSION_CARDINALITY_UNRESOLVED"),
        (~F.col("binding"), "NONBINDING_OR_NOT_YET_EFFECTIVE"),
    ]
    reasons = F.filter(F.array(*[F.when(x, name) for x, name in said]), lambda r: r.isNotNull())
    alarming = F.filter(F.col("reasons"), lambda r: ~r.isin("SUCCESSION_CARDINALITY_UNRESOLVED", "NONBINDING_OR_NOT_YET_EFFECTIVE"))
    df = df.withColumns({"timeline_state": timeline_state(F.col("status"), F.col("binding")), "reasons": reasons})
    df = df.withColumn("alert", F.size(alarming) > 0)
    derived = ["severity", "binding", "timeline_state", "cardinality", "scopes", "reasons", "alert"]
    return df.withColumns({c: F.when(F.col("fault").isNull(), F.col(c)) for c in derived})
