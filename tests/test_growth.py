"""Work that grows with the rows stays off the driver and isn't done twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import linkage
from ledgerline.plans import influence, resolution
from ledgerline.queries import sums

from conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_longest_alias_never_sends_the_runs_of_texts_to_the_driver(spark):
    texts = spark.createDataFrame([(i, f"about red fox {i}") for i in range(20)], "i int, t string")
    aliases = spark.createDataFrame([("red fox", "RF"), ("fox", "F")], "alias string, subject string")
    found = linkage.longest_alias(texts, "i", F.split("t", " "), aliases, 2)
    assert "BroadcastHashJoin" not in _plan(found)
    assert {tuple(r) for r in found.collect()} == {(i, "red fox", "RF") for i in range(20)}


def test_arcs_are_tallied_without_a_sort(spark):
    rows = spark.createDataFrame([(0, "X", "X", 10.0), (1, "X", "Y", 5.0), (2, "Y", "X", None)], "n long, awarding_agency string, recipient_name string, amount double")
    edges, labels = influence.arcs([("award", "a", rows, "n")], {"a": "observed"})
    for df in (influence.tallied(edges), influence.tallied(influence.arcs([("bond", "b", rows.withColumnsRenamed({"awarding_agency": "issuer", "recipient_name": "dealer"}), "n")], {})[0])):
        assert "SortAggregate" not in _plan(df) and " Sort " not in _plan(df)
    got = influence.nodes_measured(edges, labels)
    assert {tuple(r) for r in got.collect()} == {("X", 4, 25.0, 25.0, 4, "observed", "agency"), ("Y", 2, 5.0, 5.0, 2, "observed", "prime")}


def test_records_meet_in_their_blocks_and_pairs_are_not_shuffled(spark):
    arrays = "aliases array<string>, officers array<string>, contracts array<string>, clients array<string>"
    one = lambda i: (f"r{i:02}", f"ALFA GRUPO W{i % 3}", [], ["P"], ["K"], [], f"ST {i % 4}", f"{i % 5}", None, 2000, 2001, 1, 1, {"uei": f"U{i % 2}"})
    df = spark.createDataFrame([one(i) for i in range(24)], f"record string, name string, {arrays}, address string, phone string, parent string, valid_from int, valid_to int, municipality int, project int, ids map<string,string>")
    for limit in (3, 7, 30):
        found = resolution.decisions(df, limit)
        plan = _plan(found)
        # after the join of blocks only what meets the first record of a crowd is joined again
        assert plan.index("SortMergeJoin") < plan.index("own_a") and "Exchange hashpartitioning(a#" not in plan.split("Union")[1].split("SortMergeJoin")[0]
        want = {(r.a, r.b) for r in resolution.pairs(df, limit).collect()}
        assert sorted((r.a, r.b) for r in found.collect()) == sorted(want)


def test_restated_reads_its_rows_once_and_never_joins_them(spark):
    rows = [("a", 1, "r1"), ("a", 2, "r2"), ("a", 2, "r3"), ("a", 3, "r4"), ("b", 1, "r5"), ("b", 4, "r6"), (None, 1, "r7"), (None, 2, "r8"), ("a", None, "r9")]
    df = spark.createDataFrame(rows, "k string, d int, r string").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    found = linkage.restated(df, ["k"], "day", "r")
    assert "Join" not in _plan(found)
    assert {x.r: x.restates for x in found.collect()} == {"r1": None, "r2": "r1", "r3": "r1", "r4": None, "r5": None, "r6": "r5", "r7": None, "r8": None, "r9": None}


def test_gates_are_dealt_by_lines(spark, monkeypatch):
    want = [tuple(r) for r in sums.production_gates(spark, SMALL).collect()]
    monkeypatch.setattr(sums, "_LINES", 500)
    found = sums.production_gates(spark, SMALL)
    n = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert _plan(found).count(f", {1 + n // 500})") >= 2  # both sides in as many parts
    assert [tuple(r) for r in found.collect()] == want
