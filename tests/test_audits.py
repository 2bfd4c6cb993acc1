"""Audits and small products on rows with nulls, blanks and ties."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerline.operators import audits
from ledgerline.plans import products


def test_transfers_need_two_ids_and_a_known_target(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", " "), (None, "b"), ("a", "x"), ("a", "b")], "s string, t string")
    known = spark.createDataFrame([("b",), ("b",), (" ",), (None,)], "id string")
    assert [tuple(r) for r in audits.transfers(rows, known, "s", "t", "id").collect()] == [("a", "b"), ("a", "b")]
    assert audits.transfers(rows, known.limit(0), "s", "t", "id").count() == 0


def test_tail_of_the_last_master(spark):
    masters = spark.createDataFrame([("A_1", 0), ("B_1", 1), ("plain", 0), (None, 5)], "id string, o int")
    rows = spark.createDataFrame([("X_1",), ("plain",), ("X_2",), (None,)], "ref string")
    assert {r.ref: r.master for r in audits.by_tail(rows, masters, "ref", "id", "o").collect()} == {"X_1": "B_1", "plain": "plain", "X_2": None, None: None}


def test_activity_before_at_the_edges_of_the_window(spark):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    events = spark.createDataFrame([(1, "k", day(730)), (2, "k", day(731)), (3, "k", None), (4, "k", day(-1)), (5, "other", day(5)), (6, "k", day(0)), (7, "dateless", day(3))], "id int, name string, at timestamp")
    active = spark.createDataFrame([("k", day(0)), ("k", day(0)), ("k", None), ("dateless", None)], "name string, active timestamp")
    got = {r.id: (r.days, r.confidence) for r in audits.preceded(events, active, ["name"], "at", "active").collect()}
    assert got == {1: (730, 0.9), 2: (731, 0.72), 3: (None, 0.72), 4: (None, 0.72), 6: (0, 0.9), 7: (None, 0.72)}


def test_suspects_by_value_and_by_absence(spark):
    entities = spark.createDataFrame([("a", None, 2e6), ("b", "p", 2e6), ("c", "", 5.0), ("d", "p", None), (" ", "p", 9e9)], "name string, parent string, total double")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "node string")
    got = {r["name"]: (r.suspect, r.high_value, r.in_graph, r.confidence) for r in audits.collapse_suspects(entities, nodes, "name", "parent", "total", "node").collect()}
    assert got == {"a": (True, True, True, 0.35), "b": (False, True, True, 0.95), "c": (False, False, True, 0.35), "d": (True, False, False, 0.95)}


def test_faults_of_replacements(spark):
    rows = [("1", None, "h", 1), ("2", "1", "h", 2), ("3", "1", "g", 0), ("4", "9", "h", 1), ("5", "5", "h", 1), ("6", "1", None, 1), ("2", None, "h", 2)]
    df = spark.createDataFrame(rows, "id string, old string, holder string, day int")
    got = sorted(tuple(r) for r in audits.replacement_faults(df, "id", "old", ["holder"], ["day"]).collect())
    assert got == [("2", "duplicate_id"), ("3", "crosses_holder"), ("3", "predates_target"), ("4", "target_missing"), ("5", "replaces_itself"), ("6", "crosses_holder")]


def test_later_times_decide_only_on_equal_earlier_ones(spark):
    rows = [("1", None, 5, 5), ("2", "1", 6, 1), ("3", "1", 5, 4), ("4", "1", 5, 5)]
    df = spark.createDataFrame(rows, "id string, old string, day int, filed int")
    assert [tuple(r) for r in audits.replacement_faults(df, "id", "old", [], ["day", "filed"]).collect()] == [("3", "predates_target")]


def test_scores_of_chains_and_places(spark):
    signals = spark.createDataFrame([("subaward_opacity", "chain", "c1", "high", 0.1, 1.0), ("parent_sub_mismatch", "chain", "c1", "high", 0.9, 1.0), ("geographic_clustering", "municipality", "Ponce", "medium", 0.8, 0.4)], ",".join(f"{c} {t}" for c, t in zip(products.SIGNAL_COLUMNS, ["string"] * 4 + ["double"] * 2, strict=True)))
    chains = spark.createDataFrame([("c1",), ("c2",)], "chain_id string")
    assert {r.chain_id: (r.score, r.n_signals, r.opacity_flag) for r in products.chain_scores(chains, signals, "chain_id").collect()} == {"c1": (0.6, 2, True), "c2": (0.0, 0, False)}
    awards = spark.createDataFrame([("Lares", "x", 2.0), ("Lares", "y", 3.0), ("Lares", "y", 1.0), (" ", "x", 9.0), (None, "x", 9.0)], "place string, who string, amount double")
    got = {r.place: (r.awards, r.total, r.top_recipient, r.score, r.n_signals) for r in products.place_scores(awards, signals, "place", "amount", "who").collect()}
    assert got == {"Lares": (3, 6.0, "y", 0.0, 0), "Ponce": (0, 0.0, None, 0.12, 1)}
    assert [tuple(r) for r in products.subject_scores(signals, ["chain"], 8).select("subject", "dominant_family").collect()] == [("c1", "parent_sub_mismatch")]


def test_summary_of_an_empty_table_and_of_null_groups(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, k string")
    text = lambda d: json.loads(products.summary_json(d, {"rows": F.count("*"), "sum": F.sum("x")}, ["k"]).head()[0])
    assert text(df) == {"rows": 2, "sum": 3, "by_k": {"": 1, "a": 1}}
    assert text(df.limit(0)) == {"rows": 0, "by_k": {}}


def test_source_rows_and_share_of_few_keys(spark):
    df = spark.range(50).withColumn("x", F.lit(2.0))
    assert {r.id: r.source_row for r in products.with_source_row(df, "id").collect()} == {i: i + 2 for i in range(50)}
    assert tuple(products.top_share(df, "id", "x").head()) == (100.0, 20.0, 0.2)
    assert tuple(products.top_share(df.limit(3), "id", "x").head()) == (6.0, 6.0, 1.0)
