"""Expressions on hand-made values."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import rules, scores, similarity, text, values
from ledgerline.plans import products
from ledgerline.sources import cache, paged


def one(spark, expression, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first().y


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, ""),
        ("", ""),
        ("LLC", ""),
        ("Acme, Inc.", "ACME"),
        ("Acme & Sons Co", "ACME AND SONS"),
        ("Compañía Eléctrica S.A.", "COMPANIA ELECTRICA"),
        ("A.B.C. Builders L.L.C.", "ABC BUILDERS"),
        ("Municipio de San Juan", "MUNICIPIO SAN JUAN"),
        ("Municipality of the San Juan", "MUNICIPIO SAN JUAN"),
        ("Municipio Autónomo de Ponce", "MUNICIPIO PONCE"),
        ("J. Smith", "J SMITH"),
    ],
)
def test_org_name(spark, raw, want):
    assert one(spark, text.org_name("x"), raw) == want


def test_other_names(spark):
    assert one(spark, text.person_name("x"), "José Peña-Ríos Jr.") == "JOSE PENA RIOS"
    assert one(spark, text.trailing_name("x"), "The Center of Health, Inc.") == ""
    assert one(spark, text.trailing_name("x"), "Health Partners Inc LLC") == "HEALTH PARTNERS"
    assert one(spark, text.graph_name("x"), "The Bank & Trust") == "BANK AND TRUST"
    assert one(spark, text.place_name("x"), "Ciudad de Mayagüez") == "MAYAGUEZ"
    assert one(spark, text.infix_name("x"), "Acme Incubator") == "ACMEUBATOR"
    assert one(spark, text.address("x"), "12 Calle Luna, Suite 3") == "12 C LUNA STE 3"
    assert one(spark, text.phone("x"), "+1 (787) 555-0101") == "7875550101"
    assert one(spark, text.slug("x"), " --- ") == "na"


@pytest.mark.parametrize(("raw", "want"), [("72127.0", "72127"), ("72001", "72001"), ("36061", ""), ("721270", ""), ("abc", ""), (None, "")])
def test_fips(spark, raw, want):
    assert one(spark, text.fips("x"), raw) == want


@pytest.mark.parametrize(("raw", "want"), [("$1,234.50", 1234.5), ("(500)", -500.0), ("n/a", None), ("", None), (None, None), ("-", None)])
def test_money(spark, raw, want):
    assert one(spark, values.money(F.col("x")), raw) == want


def test_numbers_and_dates(spark):
    assert one(spark, values.number(F.col("x")), "nan") is None
    assert one(spark, values.number(F.col("x"), 0), "abc") == 0
    assert str(one(spark, values.date_of(F.col("x")), "10/01/2020")) == "2020-10-01"
    assert one(spark, values.date_of(F.col("x")), "soon") is None
    assert one(spark, values.fiscal_year(values.date_of(F.col("x"))), "2020-10-01") == 2021
    assert one(spark, values.list_of(F.col("x")), '["a", " b ", ""]') == ["a", "b"]
    assert one(spark, values.list_of(F.col("x")), "a| b ||") == ["a", "b"]
    assert one(spark, values.list_of(F.col("x"))) == []


def test_scores(spark):
    assert one(spark, scores.entity_kind(F.col("x")), "Autoridad de Energia") == "government"
    assert one(spark, scores.entity_kind(F.col("x")), " ") == "unknown"
    assert one(spark, scores.committee_kind(F.lit("SUPER PAC X"), F.col("x")), "N") == "SUPER_PAC"
    assert one(spark, scores.committee_kind(F.lit(""), F.col("x")), "H") == "CAMPAIGN_COMMITTEE"
    only_names = {"name": F.lit(1.0), "alias": F.lit(1)}
    assert one(spark, scores.match_score(only_names)) == 0.9
    assert one(spark, scores.lobby_timing(F.lit(0), F.lit(1e6))) == 1.0
    assert one(spark, scores.lobby_timing(F.col("x").cast("int"), F.lit(1e6))) == 0.0
    assert one(spark, scores.alert_level(F.lit(95), F.lit(1), F.lit(9), F.lit(0.0))) == "urgent"
    assert one(spark, scores.alert_level(F.lit(95), F.lit(2), F.lit(5), F.lit(0.0))) == "critical"


def test_similarity():
    assert similarity.token_set_score("acme power", "power acme puerto rico") == 1.0
    assert similarity.token_set_score("", "a") == 0.0
    assert 0.5 < similarity.token_set_score("acme powr", "acme power") < 1.0


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abcXYZéñ .,&-INCLO", max_size=20), min_size=1, max_size=20))
def test_normalisers_are_idempotent(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "x string")
    for f in (text.person_name, text.place_name, text.trailing_name, text.graph_name):
        once = df.select(f("x").alias("x"))
        again = once.select(f("x").alias("y"), "x").collect()
        if f is not text.place_name:  # a prefix may stand twice
            assert all(r.x == r.y for r in again)


def test_entity_kinds_of_the_survey(spark):
    kinds = {
        "RIVERA, JUAN": "individual", "Rivera Cruz, Juan A.": "individual", "RIVERA, JUAN INC": "corporate", "ACME BUILDERS": "corporate",
        "DEPT OF HEALTH": "government", "Administración de Servicios": "government", "MUNICIPALIDAD DE PONCE": "government",
        "FUNDACIÓN COMUNITARIA": "nonprofit", "CATHEDRAL TRUST": "nonprofit", "UNDISCLOSED": "aggregate", None: "unknown",
    }
    df = spark.createDataFrame([(k,) for k in kinds], "x string").select("x", scores.entity_kind(F.col("x")).alias("k"))
    assert {r.x: r.k for r in df.collect()} == kinds


def test_labels_are_the_survey_s(spark):
    pairs = [((), ("a",), "UNRESOLVED"), (("a",), (), "UNRESOLVED"), (("a",), ("b",), "1:1"), (("a",), ("b", "c"), "1:N"), (("a", "b"), ("c",), "N:1"), (("a", "b"), ("c", "d"), "N:N"), (None, ("a",), "UNRESOLVED")]
    df = spark.createDataFrame([(list(a) if a is not None else None, list(b), w) for a, b, w in pairs], "a array<string>, b array<string>, w string")
    assert all(r.got == r.w for r in df.select("w", rules.succession(F.col("a"), F.col("b")).alias("got")).collect())
    scored = spark.createDataFrame([(0.96, "auto_merge"), (0.9, "suggested_merge"), (0.7, "possible_relationship"), (0.2, "separate")], "s double, w string")
    assert all(r.got == r.w for r in scored.select("w", scores.match_decision(F.col("s"), F.lit(True), F.lit(False)).alias("got")).collect())
    stages = spark.createDataFrame([("nothing", "fema", 3), ("nothing", "epa", 2), ("road", "fema", 5), ("llc", None, 1)], "t string, s string, w int")
    assert all(r.got == r.w for r in stages.select("w", scores.project_stage(F.col("t"), F.col("s")).alias("got")).collect())


def test_placeholders_of_the_survey(spark):
    names = ["self  employed", "Retired", "NO", "", None, "-", "VARIOUS", "Acme"]
    kept, held = products.quarantine(spark.createDataFrame([(n,) for n in names], "n string"), "n")
    assert {r.n for r in held.collect()} == {"self  employed", "Retired", "NO"} and kept.count() == 5


def test_filters_of_a_request_hold_together():
    gte, lte, eq, isin = paged.GreaterThanOrEqual, paged.LessThanOrEqual, paged.EqualTo, paged.In
    payload, rest = paged.payload_of([gte(("a",), 5), gte(("a",), 1), lte(("a",), 9), lte(("a",), 7), eq(("b",), 1), isin(("b",), (2, 3)), isin(("c",), (1, 2)), isin(("c",), (2, 3)), gte(("a",), "x")])
    assert payload == {"from": {"a": 5}, "to": {"a": 7}, "equal": {"b": [], "c": [2]}}
    assert len(rest) == 1


def test_cadences(spark, tmp_path):
    made = []
    fetch = lambda: made.append(1) or spark.range(1)
    for cadence, days, fetches in (("annual", 300, 1), (None, 6, 1), ("some day", 8, 2)):
        made.clear()
        for now in (0.0, days * 86_400.0):
            cache.cached(spark, str(tmp_path), f"s{cadence}", {"q": 1}, cadence, fetch, now)
        assert len(made) == fetches
