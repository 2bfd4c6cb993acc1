"""Detectors of risk signals on hand-made rows."""

from __future__ import annotations

import pytest

from ledgerline.plans import risk

AWARDS = "award_id string, recipient string, amount double, place string, source_lineage_path string, source_dataset string, source_record_id string"
CHAINS = "chain_id string, prime_name string, sub_name string, sub_uei string, link_confidence string, manual_review string, prime_parent string, sub_parent string"


def awards(spark, *rows):
    """Rows of (id, recipient, amount, place), with full lineage."""
    return spark.createDataFrame([(*r, "p", "d", "r") for r in rows], AWARDS)


def read(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_names_lose_legal_forms_inside_words_too(spark):
    given = ["Acme, Inc.", "acme corporation", " A  B LLC ", "Wide S.E.", "Co. of Co.", None, "Inc"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(given)], "i int, n string").orderBy("i")
    assert [r[0] for r in df.select(risk.bare_name("n")).collect()] == ["ACME,.", "ACMEORATION", "A B", "WIDE", "CO. OF", "", "INC"]


def test_concentration_has_two_grades_and_names_first_awards(spark):
    rows = [("a1", "Big LLC", 40.0, ""), ("a2", "Mid", 15.0, ""), *[(f"s{i}", f"small{i}", 5.0, "") for i in range(9)]]
    got = read(risk.concentration(awards(spark, *rows)), "subject", "entity", "severity", "value", "threshold", "evidence")
    assert got == [("BIG", "Big LLC", "high", 0.4, 0.15, "a1"), ("MID", "Mid", "medium", 0.15, 0.15, "a2")]
    many = awards(spark, *[(f"a{i:02d}", None, 1.0, None) for i in range(20)])
    assert read(risk.concentration(many), "subject", "evidence", "explanation") == [("", ";".join(f"a{i:02d}" for i in range(15)), " received 100.0% of all award money (20 of 20)")]


@pytest.mark.parametrize("amount", [0.0, -1.0, None])
def test_no_money_means_no_concentration(spark, amount):
    assert risk.concentration(awards(spark, ("a", "x", amount, ""), ("b", "x", amount, ""))).count() == 0


def test_three_awards_are_repeated(spark):
    rows = [(f"{n}{i}", n, 1.0, "") for n, k in (("two", 2), ("three", 3)) for i in range(k)]
    assert read(risk.repeat_awards(awards(spark, *rows)), "subject", "value", "evidence", "confidence") == [("THREE", 3.0, "three0;three1;three2", 0.85)]


def test_opaque_chains(spark):
    rows = [
        ("c1", "P", "S", " ", "0.9", "no", "", ""), ("c2", "P", "S", "u", "0.79", "TRUE", "", ""), ("c3", "P", "S", "u", "0.8", "no", "", ""),
        ("c4", "P", None, "u", "none", "1", None, None), ("c5", "P", "S", None, "0.0", None, "", ""), (None, None, None, None, None, None, None, None),
    ]
    got = read(risk.subaward_opacity(spark.createDataFrame(rows, CHAINS)), "subject", "severity", "value", "confidence", "explanation")
    assert got == [
        ("", "high", 1.0, 1.0, "chain  ( to ): missing_sub_uei"),
        ("c1", "high", 0.9, 0.9, "chain c1 (P to S): missing_sub_uei"),
        ("c2", "medium", 0.79, 0.79, "chain c2 (P to S): low_link_confidence:0.79, manual_review_required"),
        ("c4", "medium", 1.0, 1.0, "chain c4 (P to ): manual_review_required"),
        ("c5", "high", 0.0, 0.1, "chain c5 (P to S): missing_sub_uei, low_link_confidence:0.00"),
    ]


def test_shared_parents_need_a_parent(spark):
    rows = [("c1", "P", "S", "u", "1", "", "x ", "x"), ("c2", "P", "S", "u", "1", "", "", ""), ("c3", "P", "S", "u", "1", "", "x", "y"), ("c4", "P", "S", "u", "1", "", None, None)]
    assert read(risk.parent_sub_mismatch(spark.createDataFrame(rows, CHAINS)), "subject", "severity", "explanation") == [("c1", "high", "P and S share the parent x")]


def test_filings_and_bonds_meet_awards_by_name(spark):
    a = awards(spark, *[(f"a{i}", "Acme LLC", 1.0, "") for i in range(6)], ("b", None, 1.0, ""))
    lda = spark.createDataFrame([("ACME", "f1", "R"), ("", "f2", "R"), (None, "f3", "R"), ("Other", "f4", "R")], "client string, record string, by string")
    fec = spark.createDataFrame([("acme  ", "kim", None, 7.0), ("acme", "lee", None, None)], "client string, record string, by string, amount double")
    got = read(risk.political_overlap(a, {"lda": lda, "fec": fec}), "kind", "subject", "severity", "value", "evidence")
    assert got == [
        ("fec_contributor_employer_is_awardee", "ACME", "low", 0.0, "fec:lee;awards:a0;a1;a2;a3;a4"),
        ("fec_contributor_employer_is_awardee", "ACME", "low", 7.0, "fec:kim;awards:a0;a1;a2;a3;a4"),
        ("lobbying_client_is_awardee", "ACME", "medium", 1.0, "lda:f1;awards:a0;a1;a2;a3;a4"),
    ]
    bonds = spark.createDataFrame([("Acme Corp", "c1", 1234567.5), ("Acme", "c1", None), ("Nobody", "c2", 1.0)], "issuer string, cusip string, par double")
    got = read(risk.bond_contract_overlap(a, bonds), "entity", "value", "explanation")
    assert got == [("Acme Corp", 1234567.5, "Acme Corp issued bond c1 (1,234,568 par) and received awards"), ("Acme", 0.0, "Acme issued bond c1 (0 par) and received awards")]


def test_places_count_against_all_awards(spark):
    rows = [("1", "x", 1.0, "Lares"), ("2", "y", 1.0, "Lares"), ("3", "y", 1.0, "Lares"), *[(str(i), "z", 1.0, "") for i in range(4, 8)], *[(str(i), "z", 1.0, f"p{i}") for i in (8, 9)], ("0", "z", 1.0, None)]
    got = read(risk.geographic_clustering(awards(spark, *rows)), "subject", "value", "evidence", "explanation")
    assert got == [("Lares", 0.3, "1;2;3", "Lares has 30.0% of the awards (3 of 10), most to y, x")]


def test_lineage_and_stable_ids(spark):
    df = spark.createDataFrame([("a", "x", 1.0, "", "p", " ", None), ("b", "x", 1.0, "", "p", "d", "r")], AWARDS)
    got = risk.stale_lineage(df)
    assert read(got, "subject", "value", "explanation") == [("a", 2.0, "award a lacks source_dataset, source_record_id")]
    assert read(got, "signal_id") == read(risk.stale_lineage(df.repartition(3)), "signal_id")
    assert got.head().signal_id.startswith("SIG-STAL-")


def test_all_detectors_on_empty_tables(spark):
    none = awards(spark).limit(0)
    chains = spark.createDataFrame([], CHAINS)
    filings = {"lda": spark.createDataFrame([], "client string, record string, by string")}
    bonds = spark.createDataFrame([], "issuer string, cusip string, par double")
    got = risk.detect(none, chains, filings, bonds)
    assert got.columns == risk.COLUMNS and got.count() == 0
    assert risk.entity_scores(got).count() == 0


def test_scores_name_families_and_mean_confidence(spark):
    a = awards(spark, *[(f"a{i}", "Acme LLC", 1.0, "") for i in range(3)])
    bonds = spark.createDataFrame([("Acme Corp", "c", 5.0)], "issuer string, cusip string, par double")
    signals = risk.concentration(a).unionByName(risk.repeat_awards(a)).unionByName(risk.bond_contract_overlap(a, bonds))
    # (1.0 * 1.0 * 0.90 + 0.7 * 0.6 * 0.85 + 0.5 * 0.6 * 0.85) / 8
    assert read(risk.entity_scores(signals), "subject", "entity", "score", "n_signals", "dominant_family", "families", "confidence") == [
        ("ACME", "Acme LLC", 0.189, 3, "concentration", "bond_contract_overlap;concentration;repeat_awards", 0.8667)
    ]
