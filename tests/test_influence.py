"""The graph of influence on hand-made rows."""

from __future__ import annotations

import pytest

from ledgerline.plans import influence


def table(spark, columns, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, " + ", ".join(f"{c} string" for c in columns.split()))


def arcs(spark, kind, columns, *rows, tiers=None):
    return influence.arcs([(kind, "set", table(spark, columns, *rows), "n")], tiers or {})


def read(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_an_award_gives_three_arcs_and_blank_ends_none(spark):
    edges, labels = arcs(spark, "award", "awarding_agency vendor_name parent_name county total_obligation award_id", ("DOE", " Acme ", "Holding", "Lares", "$1,234.567", "a1"), ("DOE", "", "H", "Lares", "1", "a2"), (None, "Acme", None, None, "x", None), tiers={"set": "linked"})
    assert read(edges, "source", "target", "verb", "weight", "evidence", "confidence", "review", "tier") == [
        ("Acme", "Lares", "located_in", 1.0, "a1", 0.6, True, "linked"),
        ("DOE", "Acme", "awards_to", 1234.57, "a1", 0.75, True, "linked"),
        ("Holding", "Acme", "parent_of", 1.0, "a1", 0.9, False, "linked"),
    ]
    assert labels.count() == 0


def test_amounts_come_from_the_first_readable_column(spark):
    edges, _ = arcs(spark, "award", "funding_agency uei recipient_name obligated_amount amount", ("A", "u", "x", "none", "5"), ("A", "u", "y", "", "-7"))
    assert read(edges, "target", "weight") == [("x", 5.0), ("y", -7.0)]


def test_parents_by_id_before_name(spark):
    entities = table(spark, "entity_uei normalized_name parent_uei parent_name", ("u1", "acme", "", "P1"), ("u1", "other", "late", ""), ("u2", "beta", "", ""), ("", "", "nobody", ""), (None, "gamma", "P3", "x"))
    awards = table(spark, "recipient_uei recipient_name", ("u1", "beta"), ("u2", "acme"), ("u9", "acme"), ("", "gamma"), (None, None))
    got = influence.with_parent(awards, entities, "n").orderBy("n")
    # a found entity without a parent ends the search
    assert [r.resolved_parent for r in got.collect()] == ["P1", "", "P1", "P3", ""]


def test_chains_fall_back_along_their_parts(spark):
    columns = "prime_parent_uei prime_name sub_name asset_id project_id municipality link_confidence chain_id"
    edges, _ = arcs(spark, "chain", columns, ("PP", "P", "S", "", "proj", "Lares", "0.8", "c1"), ("", "P", "", "A", "", "Lares", "", "c2"), ("", "P", "", "", "", "Ponce", "bad", "c3"))
    assert read(edges, "source", "target", "verb", "confidence", "review", "evidence") == [
        ("A", "Lares", "located_in", 0.6, True, "c2"), ("P", "A", "executes_project", 0.5, True, "c2"), ("P", "Ponce", "located_in", 0.6, True, "c3"),
        ("PP", "S", "subawards_to", 0.8, False, "c1"), ("S", "proj", "executes_project", 0.8, False, "c1"), ("proj", "Lares", "located_in", 0.6, True, "c1"),
    ]


@pytest.mark.parametrize("said, want", [("90", 0.9), ("100", 0.95), ("", 0.0), (None, 0.0), ("high", 0.45), ("NaN", 0.45)])
def test_ratings_of_nonprofits(spark, said, want):
    edges, _ = arcs(spark, "ngo_funding", "source_entity target_ngo_id confidence", ("A", "N", said))
    assert read(edges, "confidence", "review") == [(want, want < 0.8)]


@pytest.mark.parametrize("kind, columns", [("lobbying", "registrant client"), ("contribution", "donor committee")])
def test_filings_without_money_weigh_one(spark, kind, columns):
    edges, _ = arcs(spark, kind, f"{columns} amount", ("a", "b", ""), ("a", "b", "0"), ("a", "b", "2.5"))
    assert read(edges, "weight") == [(1.0,), (1.0,), (2.5,)]


def test_nodes_are_what_their_first_row_says(spark):
    awards = table(spark, "awarding_agency recipient_name", ("X", "Y"), ("Y", "X"))
    funding = table(spark, "source_entity target_ngo_id target_name", ("X", "N1", "Hope"), ("X", "N1", "Later"), ("X", "N2", ""), ("", "N3", "Alone"))
    edges, labels = influence.arcs([("award", "a", awards, "n"), ("ngo_funding", "f", funding, "n")], {})
    assert read(influence.nodes(edges, labels), "node", "label", "node_type") == [("N1", "Hope", "ngo"), ("N2", "N2", "ngo"), ("N3", "Alone", "ngo"), ("X", "X", "agency"), ("Y", "Y", "prime")]


def test_metrics_count_loops_twice_and_take_the_worst_tier(spark):
    awards = table(spark, "awarding_agency recipient_name amount", ("X", "X", "10"), ("X", "Y", "5"))
    bonds = table(spark, "issuer dealer amount", ("Y", "Z", "1"))
    edges, labels = influence.arcs([("award", "a", awards, "n"), ("bond", "b", bonds, "n")], {"a": "observed", "b": "linked"})
    got = influence.metrics(edges, influence.nodes(edges, labels))
    assert read(got, "node", "node_type", "degree", "weighted_degree", "contract_weight", "review_edges", "tier") == [
        ("X", "agency", 3, 25.0, 25.0, 3, "observed"), ("Y", "prime", 2, 6.0, 6.0, 1, "linked"), ("Z", "underwriter", 1, 1.0, 1.0, 0, "linked"),
    ]
    assert [r.node for r in influence.top_control(got, 2).collect()] == ["X", "Y"]
    assert {r.tier for r in influence.arcs([("award", "new", awards, "n")], {})[0].collect()} == {"blocked"}


def test_every_kind_takes_an_empty_table_with_other_columns(spark):
    none = table(spark, "unknown").limit(0)
    for kind in influence.KINDS:
        edges, labels = influence.arcs([(kind, "set", none, "n")], {})
        assert edges.count() == 0 and influence.nodes(edges, labels).count() == 0
