"""Name, place and identifier normalisers as column expressions.

All are null-safe: null gives an empty string, as blank does, unless said otherwise.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form words dropped anywhere in a name.
LEGAL_FORMS = (
    "CO", "COMPANY", "CORP", "CORPORATION", "GMBH", "INC", "INCORPORATED", "INTERNATIONAL", "INTL", "LIMITED",
    "LLC", "LLP", "LP", "LTD", "PC", "PLC", "PSC", "SA", "SE",
)
# Words dropped only from the end of a name.
TRAILING_WORDS = (
    "AND", "CENTER", "CENTRE", "CO", "CORP", "DBA", "HEALTH", "HOSPITAL", "INC", "LLC", "LLP", "LP", "LTD", "OF",
    "PC", "PLLC", "SA", "SRL", "THE",
)
# Generation marks dropped from names of persons.
GENERATIONS = ("II", "III", "IV", "JR", "SR", "V")
# Street words and their short forms.
STREET_WORDS = {
    "APARTMENT": "APT", "AVENIDA": "AVE", "AVENUE": "AVE", "CALLE": "C", "CARRETERA": "CARR", "ROAD": "RD",
    "STREET": "ST", "SUITE": "STE", "URBANIZACION": "URB",
}


def _fold_table() -> tuple[str, str]:
    """Letters below U+0250 whose decomposition is one ASCII letter and marks."""
    source, target = [], []
    for n in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(n)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base != chr(n):
            source.append(chr(n))
            target.append(base)
    return "".join(source), "".join(target)


_FOLD = _fold_table()


def text(c: Column | str) -> Column:
    """Null as an empty string."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fold(c: Column) -> Column:
    """Accents off."""
    return F.translate(c, *_FOLD)


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def without_words(c: Column, words: Iterable[str]) -> Column:
    """A space-separated text without some words."""
    drop = list(words)
    return F.array_join(F.filter(F.split(c, " "), lambda w: (w != "") & ~w.isin(drop)), " ")


def without_trailing(c: Column, words: Iterable[str]) -> Column:
    """A space-separated text without some words at its end."""
    return F.regexp_replace(c, "(?:(?:^| )(?:" + "|".join(words) + "))+$", "")


# What stands before the name of a town in names of organisations, and in names of places.
TOWN_PREFIXES = ["MUNICIPIO AUTONOMO DE", "MUNICIPIO DE", "MUNICIPALITY OF THE", "MUNICIPALITY OF"]
PLACE_PREFIXES = ["MUNICIPIO DE", "MUNICIPALITY OF", "CIUDAD DE", "CITY OF"]


def _begins(prefixes: Iterable[str]) -> str:
    """A pattern for a text that begins with one of the prefixes and goes on behind it, whatever space is between words."""
    longest_first = sorted(prefixes, key=len, reverse=True)
    return "^(?:" + "|".join(r"\s+".join([*p.split(" "), ""]) for p in longest_first) + ")"


def org_name(c: Column | str) -> Column:
    """Accents, legal forms and signs off; ``&`` is AND, dotted initials join, municipalities share one prefix."""
    s = fold(F.upper(text(c)))
    s = F.regexp_replace(s, _begins(TOWN_PREFIXES), "MUNICIPIO ")
    s = F.regexp_replace(s, r"\s*&\s*", " AND ")
    # in a run of two or more initials every dot goes
    s = F.regexp_replace(s, r"(?<=\b[A-Z])\.(?=[A-Z]\.)|(?<=\b[A-Z]\.[A-Z])\.|(?<=[A-Z]\.[A-Z])\.", "")
    return without_words(squeeze(F.regexp_replace(s, "[^A-Z0-9 ]+", " ")), LEGAL_FORMS)


def person_name(c: Column | str) -> Column:
    """Accents and signs off, generation marks dropped, all surnames kept."""
    s = F.regexp_replace(fold(F.upper(text(c))), "[^A-Z0-9 ]+", " ")
    return without_words(squeeze(s), GENERATIONS)


def trailing_name(c: Column | str, words: Iterable[str] = TRAILING_WORDS) -> Column:
    """Signs off, some words dropped from the end only."""
    s = squeeze(F.regexp_replace(F.upper(text(c)), r"(?U)[^\w\s]", " "))
    return without_trailing(s, words)


def infix_name(c: Column | str, parts: Iterable[str] = (" INC", " LLC", " CORP", " LTD", " CO")) -> Column:
    """The variant that removes legal forms wherever they stand, inside words too."""
    s = F.upper(text(c))
    for p in parts:
        s = F.replace(s, F.lit(p), F.lit(""))
    return squeeze(F.regexp_replace(s, "[^A-Z0-9 ]+", " "))


def graph_name(c: Column | str) -> Column:
    """ASCII letters and digits only, ``&`` is AND, THE dropped."""
    s = F.regexp_replace(fold(text(c)), r"[^\x00-\x7F]", "")
    s = F.regexp_replace(F.replace(F.upper(s), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9]+", " ")
    return without_words(F.trim(s), ("THE",))


def place_name(c: Column | str) -> Column:
    """Accents, signs and words for town or city in front off."""
    s = F.upper(fold(F.trim(text(c))))
    s = F.regexp_replace(s, _begins(PLACE_PREFIXES), "")
    return squeeze(F.regexp_replace(s, "[^A-Z0-9 ]+", " "))


def fips(c: Column | str, state: str = "72") -> Column:
    """Five digits of a county code of one state, else empty."""
    s = F.regexp_replace(F.trim(text(c)), r"\.0$", "")
    padded = F.lpad(s, 5, "0")
    return F.when(s.rlike("^[0-9]{1,5}$") & padded.startswith(state), padded).otherwise("")


def address(c: Column | str) -> Column:
    """Upper case, signs off, street words short."""
    words = F.split(squeeze(F.regexp_replace(F.upper(text(c)), "[^A-Z0-9 ]+", " ")), " ")
    short = F.create_map(*[F.lit(x) for pair in STREET_WORDS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def digits(c: Column | str) -> Column:
    return F.regexp_replace(text(c), "[^0-9]", "")


def phone(c: Column | str) -> Column:
    """The last ten digits."""
    return F.when(F.length(digits(c)) >= 10, F.right(digits(c), F.lit(10))).otherwise(digits(c))


def slug(c: Column | str, default: str = "na") -> Column:
    """Lower-case letters and digits joined by underscores."""
    s = F.regexp_replace(F.lower(F.trim(text(c))), "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.when(s == "", default).otherwise(s)


def hashed(payload: Column, length: int) -> Column:
    return F.substring(F.sha2(payload, 256), 1, length)


def node_id(kind: str, name: Column | str, length: int = 16) -> Column:
    """Id of a named node: kind and a hash of the normalised name."""
    normal = person_name(name) if kind == "person" else org_name(name)
    return F.concat(F.lit(kind + "_"), hashed(normal, length))


def slug_id(kind: str, *parts: Column | str) -> Column:
    """Id of slugs: contracts, projects, debts, filings, programmes, places, assets."""
    return F.concat_ws("_", F.lit(kind), *[slug(p) for p in parts])


def edge_id(source: Column | str, verb: Column | str, target: Column | str, length: int = 16) -> Column:
    return F.concat(F.lit("edge_"), hashed(F.concat_ws("|", text(source), text(verb), text(target)), length))


def federation_id(prefix: str, word: str, *parts: Column | str) -> Column:
    """Id of the exchange format: prefix and 32 hex digits."""
    return F.concat(F.lit(prefix + "_"), hashed(F.concat_ws("|", F.lit(word), *[text(p) for p in parts]), 32))


def first_filled(*columns: Column | str) -> Column:
    """The first value that isn't blank, trimmed; null if there is none."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit("")) for c in columns])
