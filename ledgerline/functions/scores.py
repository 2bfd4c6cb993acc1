"""Scores, confidences and classifiers as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold


def _flag(c: Column, points: float) -> Column:
    return F.when(c, F.lit(points)).otherwise(F.lit(0.0))


def additive(parts: Iterable[tuple[Column, float]], cap: float | None = None) -> Column:
    """Sum of the points whose condition holds, at most cap."""
    total = None
    for condition, points in parts:
        total = _flag(condition, points) if total is None else total + _flag(condition, points)
    return total if cap is None else F.least(total, F.lit(float(cap)))


def bands(c: Column, steps: list[tuple[float, str]], lowest: str) -> Column:
    """The label of the highest step that is reached."""
    out = None
    for least, label in sorted(steps, reverse=True):
        out = F.when(c >= least, label) if out is None else out.when(c >= least, label)
    return out.otherwise(lowest)


def first_keyword(c: Column, rules: list[tuple[str, tuple[str, ...]]], otherwise: str | int) -> Column:
    """The label of the first rule one of whose words the text holds."""
    out = None
    for label, words in rules:
        hit = None
        for w in words:
            hit = c.contains(w) if hit is None else hit | c.contains(w)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def keyword_hits(c: Column, words: Iterable[str]) -> Column:
    """How many of the words the text holds."""
    total = F.lit(0)
    for w in words:
        total = total + c.contains(w).cast("int")
    return total


def link_confidence(published: Column, any_id: Column, prime_name: Column, in_index: Column, sub_name: Column, prime_uei: Column, sub_uei: Column) -> Column:
    """Confidence of a prime to subaward link, 0 to 1."""
    base = F.when(published, 0.40).when(any_id, 0.25).otherwise(0.0)
    rest = additive([(prime_name, 0.20), (in_index, 0.15), (sub_name, 0.15), (prime_uei, 0.05), (sub_uei, 0.05)])
    return F.round(F.least(base + rest, F.lit(1.0)), 3)


# Weights of the features of an entity match.
MATCH_WEIGHTS = {
    "exact_id": 0.60,
    "name": 0.55,
    "alias": 0.35,
    "address": 0.18,
    "officer": 0.18,
    "phone": 0.12,
    "parent": 0.12,
    "contract": 0.12,
    "lobby": 0.12,
    "municipality": 0.12,
    "temporal": 0.06,
}


def match_score(features: dict[str, Column]) -> Column:
    """Weighted evidence, 0 to 1; at most 0.90 if names are all there is."""
    part = {k: F.least(F.greatest(c.cast("double"), F.lit(0.0)), F.lit(1.0)) * MATCH_WEIGHTS[k] for k, c in features.items()}
    total = other = F.lit(0.0)
    for k, c in part.items():
        total = total + c
        if k not in ("name", "alias"):
            other = other + c
    total = F.least(total, F.lit(1.0))
    return F.round(F.when(other > 0, total).otherwise(F.least(total, F.lit(0.90))), 4)


def match_decision(score: Column, shares_id: Column, disagrees: Column) -> Column:
    """Merges are automatic only with an agreeing authoritative identifier."""
    return (
        F.when((score >= 0.95) & shares_id & ~disagrees, "auto_merge")
        .when(score >= 0.85, "suggested_merge")
        .when(score >= 0.65, "possible_relationship")
        .otherwise("separate")
    )


def lobby_timing(lead_days: Column, spend: Column, window: int = 180) -> Column:
    """Recent and well-funded lobbying before a posting scores high."""
    recency = F.greatest(F.lit(1), F.lit(window) - lead_days) / F.lit(window)
    share = F.lit(0.6) + F.lit(0.4) * F.log1p(spend) / F.log1p(F.lit(1e6))
    return F.when(lead_days.isNull(), 0.0).otherwise(F.round(F.least(F.lit(1.0), recency * share), 4))


def delivery(completion: Column, disbursed: Column, permit: Column, clean: Column) -> Column:
    """0 to 100 from four shares; null completion or disbursement is neutral."""
    c, d = F.coalesce(completion, F.lit(0.5)), F.coalesce(disbursed, F.lit(0.5))
    return F.round((0.35 * c + 0.30 * d + 0.20 * permit + 0.15 * clean) * 100, 1)


def delivery_risk(score: Column) -> Column:
    return F.when(score < 40, "high").when(score < 70, "medium").otherwise("low")


def nonprofit_confidence(ein: Column, uei: Column, state_id: Column, irs: Column, pr: Column, place: Column, name: Column, federal: Column, state: Column) -> Column:
    """0 to 100 from identifiers, statuses and registries."""
    parts = [(ein, 30), (uei, 20), (state_id, 20), (irs, 10), (pr, 10), (place, 10), (name, 10), (federal, 15), (state, 10)]
    return additive(parts, 100)


NONPROFIT_BANDS = [(90, "confirmed"), (75, "strong_probable"), (60, "probable"), (40, "needs_review")]
ALERT_BANDS = [(90, "critical"), (75, "urgent"), (55, "review"), (35, "watch")]

# Words for the stage of a project, latest stage first.
STAGE_WORDS: list[tuple[int, tuple[str, ...]]] = [
    (8, ("amendment", "modification", "change order", "expansion")),
    (7, ("maintenance", "security", "operations", "staffing", "concession")),
    (6, ("construction", "site work", "materials", "earthwork", "build")),
    (5, ("road", "water", "power", "substation", "drainage", "telecom", "utility")),
    (4, ("engineering", "design", "study", "legal", "consulting", "architecture")),
    (3, ("grant", "funding", "budget", "bond", "appropriation")),
    (2, ("permit", "zoning", "environmental", "public hearing", "land use")),
    (1, ("llc", "corporation", "registered agent", "entity")),
]


# Source datasets that place a record at a stage at least.
STAGE_SOURCES: dict[int, tuple[str, ...]] = {
    3: ("aaafa", "cor3", "fema", "cdbg_dr", "hud", "doe", "preb", "luma", "prepa", "genera"),
    2: ("ogpe", "junta_planificacion", "planning", "drna", "epa", "municipio_records"),
}


def project_stage(c: Column, source: Column | None = None) -> Column:
    """The latest stage that a word of the text, or the source dataset, speaks of."""
    by_word = first_keyword(F.lower(c), STAGE_WORDS, 0)
    if source is None:
        return by_word
    of_source = F.lit(0)
    for stage, names in STAGE_SOURCES.items():
        of_source = F.when(F.lower(source).isin(*names), stage).otherwise(of_source)
    return F.greatest(by_word, of_source)


def alert_level(score: Column, families: Column, stage: Column, amount: Column) -> Column:
    """Critical needs two source families and a late stage or a large amount."""
    sure = (families >= 2) & ((stage >= 5) | (F.coalesce(amount, F.lit(0.0)) >= 1e6))
    level = bands(score, ALERT_BANDS, "none")
    return F.when((level == "critical") & ~sure, "urgent").otherwise(level)


# Kinds of entity by words in the name, first that fits; accents are folded before.
ENTITY_WORDS: list[tuple[str, tuple[str, ...]]] = [
    ("aggregate", ("MULTIPLE RECIPIENTS", "VARIOUS RECIPIENTS", "ALL RECIPIENTS", "UNDISCLOSED")),
    ("government", (
        "DEPARTMENT OF", "DEPARTAMENTO DE", "DEPT OF", "ADMINISTRACION", "ADMINISTRATION OF", "AUTORIDAD", "AUTHORITY OF",
        "MUNICIPIO", "MUNICIPALITY OF", "MUNICIPALIDAD", "GOVERNMENT OF", "GOBIERNO DE", "GOVERNOR'S", "COMMONWEALTH OF",
        "ESTADO LIBRE ASOCIADO", "SECRETARIA", "JUNTA DE", "JUNTA OF", "OFICINA DE", "TRIBUNAL", "POLICIA",
        "POLICE DEPARTMENT", "HACIENDA", "CONSEJO DE", "DEPARTAMENTO", "AGENCIA",
    )),
    ("nonprofit", (
        "UNIVERSITY", "UNIVERSIDAD", "COLLEGE", "ESCUELA GRADUADA", "FOUNDATION", "FUNDACION", "IGLESIA", "CHURCH",
        "CATHEDRAL", "NONPROFIT", "NON-PROFIT", "COOPERATIVE", "COOPERATIVA",
    )),
]
# What follows the comma in the name of a firm.
FIRM_SUFFIXES = ("LLC", "INC", "CORP", "SA", "CSP", "LTD", "PSC", "CO", "S.A.", "SRL")
# One-letter codes of committees.
COMMITTEES = {
    "H": "CAMPAIGN_COMMITTEE", "N": "PAC", "O": "SUPER_PAC", "P": "CAMPAIGN_COMMITTEE", "Q": "PAC", "S": "CAMPAIGN_COMMITTEE",
    "U": "SUPER_PAC", "X": "PARTY_COMMITTEE", "Y": "PARTY_COMMITTEE", "Z": "NATIONAL_PARTY_NONFEDERAL",
}


def entity_kind(c: Column) -> Column:
    """Kind of an entity by its name; "SURNAME, NAME" without a firm's suffix is a person."""
    name = F.trim(F.upper(fold(F.coalesce(c, F.lit("")))))
    before = F.trim(F.substring_index(name, ",", 1))
    after = F.trim(name.substr(F.instr(name, ",") + 1, F.length(name)))
    words = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    person = name.contains(",") & (words(before) <= 2) & (words(after) <= 3) & (keyword_hits(after, FIRM_SUFFIXES) == 0)
    other = F.when(person, "individual").otherwise("corporate")
    return F.when(name == "", "unknown").otherwise(F.coalesce(F.nullif(first_keyword(name, ENTITY_WORDS, ""), F.lit("")), other))


def committee_kind(said: Column, code: Column) -> Column:
    """Words win over the code."""
    codes = F.create_map(*[F.lit(x) for pair in COMMITTEES.items() for x in pair])
    return (
        F.when(said.contains("JOINT FUNDRAISING"), "JOINT_FUNDRAISING_COMMITTEE")
        .when(said.contains("527"), "POLITICAL_527")
        .when(said.contains("INDEPENDENT EXPENDITURE ONLY") | said.contains("SUPER PAC"), "SUPER_PAC")
        .otherwise(F.coalesce(F.try_element_at(codes, code), F.lit("POLITICAL_COMMITTEE")))
    )
