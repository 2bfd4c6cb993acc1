"""Rule sets: categories, places, adjudication and states, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scores import first_keyword, keyword_hits
from .text import digits, fold, squeeze, text

# Words taken off vendor names wherever they stand as words.
VENDOR_WORDS = (
    "ASSOCIATES", "AUTH", "AUTHORITY", "CO", "COMPANY", "CONSTRUCTION", "CONSULTANTS?", "CONTRACTORS?", "CORP",
    "CORPORATION", "ENTERPRISES", "GROUP", "INC", "INCORPORATED", "INTERNATIONAL", "LIMITED", "LLC", "LLP", "LTD",
    "PSC", "SERVICES", "SOLUTIONS",
)
# Classes of funded assets by words, first that fits.
ASSET_WORDS: list[tuple[str, tuple[str, ...]]] = [
    ("debris", ("cat a", "cat. a", "category a", "debris")),
    ("emergency", ("cat b", "cat. b", "category b", "emergency protective", "protective measures")),
    ("roads_bridges", ("bridge", "cat c", "cat. c", "category c", "culvert", "highway", "road")),
    ("water_control", ("cat d", "cat. d", "category d", "channel", "dam", "dike", "irrigation", "levee", "water control")),
    ("buildings", ("building", "cat e", "cat. e", "category e", "equipment", "facility", "hospital", "school", "vehicle")),
    ("utilities", ("cat f", "cat. f", "category f", "electric", "grid", "power", "sewer", "treatment plant", "utilities", "utility", "wastewater", "water system")),
    ("parks_rec", ("beach", "cat g", "cat. g", "category g", "park", "playground", "recreation")),
]
# Confidence of the ways in which a place was found.
PLACE_CONFIDENCE = {"agency_default": 0.30, "code_exact": 0.97, "headquarters": 0.50, "name_exact": 0.90, "name_normalized": 0.80, "none": 0.0, "outside_pr": 0.60}
HOME = ("PR", "PUERTO RICO", "UNITED STATES", "US", "USA")


# Fixed value: the signs that part words of a vendor's name.
VENDOR_SIGNS = r"[,.\-/&'()]"


def vendor_name(c: Column | str) -> Column:
    """Accents, signs and legal or trade words off."""
    s = F.regexp_replace(F.upper(fold(text(c))), VENDOR_SIGNS, " ")
    return squeeze(F.regexp_replace(s, r"\b(?:" + "|".join(VENDOR_WORDS) + r")\b", " "))


def asset_class(*said: Column) -> Column:
    return first_keyword(F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in said])), ASSET_WORDS, "other")


def tax_subsection(c: Column) -> Column:
    """Political bucket of a 501(c) subsection."""
    d = digits(c)
    return F.when(d.isin("4", "5", "6"), "likely_political").when(d == "3", "restricted_charity").otherwise("other")


def categories(c: Column, rules: dict[str, tuple[str, ...]], least: int, review: int, never: tuple[str, ...] = ()) -> Column:
    """Struct of the categories whose words are hit often enough and the decision: accept, review or reject."""
    low = F.lower(F.coalesce(c, F.lit("")))
    hits = {k: keyword_hits(low, w) for k, w in rules.items()}
    names = F.array_compact(F.array(*[F.when(n >= review, F.lit(k)) for k, n in hits.items()]))
    most = F.greatest(*hits.values()) if len(hits) > 1 else next(iter(hits.values()))
    veto = keyword_hits(low, never) > 0 if never else F.lit(False)
    return F.struct(names.alias("names"), F.when(veto, "reject").when(most >= least, "accept").when(most >= review, "review").otherwise("reject").alias("decision"))


def place_reason(country: Column, state: Column, county: Column, code: Column, known: Column, name: Column, named: Column) -> Column:
    """Why a place is what it is: foreign, other state, code, name, missing - in that order.

    known: the code is one of the places; named: the name is.
    """
    up = lambda c: F.trim(F.upper(fold(F.coalesce(c, F.lit("")))))
    raw = F.regexp_replace(F.trim(F.coalesce(code, F.lit(""))), r"\.0$", "")
    of_code = (
        F.when(known, "code_exact")
        .when(raw.rlike("^72[0-9]{3}$"), "invalid_code")
        .when(raw.rlike("^[0-9]{5}$"), "outside_county")
        .when(raw.rlike("^[0-9]+$"), "invalid_code")
        .otherwise("parser_failed")
    )
    return (
        F.when((up(country) != "") & ~up(country).isin(*HOME), "outside_foreign")
        .when(~up(state).isin("", "PR", "PUERTO RICO"), F.when(F.coalesce(county, F.lit("")) != "", "outside_county").otherwise("outside_state"))
        .when(raw != "", of_code)
        .when(F.trim(F.coalesce(name, F.lit(""))) != "", F.when(named, "name_normalized").otherwise("ambiguous"))
        .otherwise("missing")
    )


def adjudicate(left_id: Column, right_id: Column) -> Column:
    """PASS only if both sides carry the same stable identifier."""
    a, b = F.trim(F.coalesce(left_id, F.lit(""))), F.trim(F.coalesce(right_id, F.lit("")))
    return F.when((a != "") & (a == b), "PASS").when((a != "") & (b != ""), "FAIL").otherwise("UNRESOLVED")


def succession(old: Column, new: Column) -> Column:
    """Cardinality of an organisation change: how many stand before and after, UNRESOLVED if one side is empty or null."""
    n, m = (F.coalesce(F.size(x), F.lit(0)) for x in (old, new))
    side = lambda k: F.when(k == 1, "1").otherwise("N")
    return F.when((n <= 0) | (m <= 0), "UNRESOLVED").otherwise(F.concat_ws(":", side(n), side(m)))


def materialisation(there: Column, rows: Column, least: int, fixture: Column) -> Column:
    """State of a dataset from its file and row count."""
    return F.when(~there, "missing").when(fixture, "fixture").when(rows == 0, "empty").when(rows < least, "below_minimum").otherwise("materialised")


def completeness_label(rows: Column, fixture: Column, validated: Column, fresh: Column) -> Column:
    return (
        F.when(rows == 0, "empty")
        .when(fixture, "fixture")
        .when(validated & fresh, "validated_complete")
        .when(validated, "complete_stale")
        .when(rows >= 1000, "substantial")
        .when(rows >= 50, "partial")
        .otherwise("seed")
    )


def missing_gates(states: Column, wanted: list[str]) -> Column:
    """Of the gates wanted, sorted, those not true in a map of states."""
    names = F.array(*[F.lit(w) for w in sorted(wanted)])
    return F.filter(names, lambda w: ~F.coalesce(F.try_element_at(states, w), F.lit(False)))


def enriched(existing: Column, new: Column) -> Column:
    """What is there stays; only blanks are filled."""
    return F.coalesce(F.nullif(F.trim(existing), F.lit("")), new)


def with_source_id(system: str, award: Column, ordinal: Column) -> Column:
    """``system:award`` or, without one, ``system:ROW_n``."""
    a = F.nullif(F.trim(award), F.lit(""))
    return F.concat(F.lit(system + ":"), F.coalesce(a, F.concat(F.lit("ROW_"), ordinal.cast("string"))))
