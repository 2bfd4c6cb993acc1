"""Sampled betweenness: exact with all sources, within its bound on a graph of 20,000 nodes."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import graph

EDGES = "src long, dst long, weight double"


def test_all_sources_are_exact(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(40), rng.randrange(40), float(rng.choice([1, 1, 2, 3]))) for _ in range(75)] + [(100, 101, 1.0)]
    df = spark.createDataFrame(rows, EDGES)
    want = {r.node: r.betweenness for r in graph.betweenness(df).collect()}
    got = {r.node: (r.betweenness, r.error) for r in graph.sampled_betweenness(df, 1000).collect()}
    assert got == {k: (pytest.approx(v, abs=1e-6), 0.0) for k, v in want.items()} and max(want.values()) > 10
    assert graph.sampled_betweenness(spark.createDataFrame([], EDGES)).count() == 0


def test_large_tree_is_within_the_bound(spark):
    n, wide = 20_000, 12
    df = spark.range(1, n).selectExpr("id AS src", f"(id - 1) div {wide} AS dst", "1.0D AS weight")
    size = [1] * n
    for k in range(n - 1, 0, -1):
        size[(k - 1) // wide] += size[k]
    # in a tree a node lies between all pairs of the parts that it holds together
    parts = [[n - size[0]] for _ in range(1)] + [[n - size[k]] for k in range(1, n)]
    for k in range(1, n):
        parts[(k - 1) // wide].append(size[k])
    want = [(sum(p) ** 2 - sum(x * x for x in p)) / 2 for p in parts]
    got = {r.node: r for r in graph.sampled_betweenness(df, 24).collect()}
    assert len(got) == n and all(abs(got[k].betweenness - want[k]) <= got[k].error for k in range(n))
    # far better than the bound where it matters
    top = sorted(range(n), key=lambda k: -want[k])[:3]
    assert all(abs(got[k].betweenness - want[k]) < 0.25 * want[k] for k in top[:1])


def test_equal_lengths_meet_an_edge_once_for_all_sources(spark, monkeypatch):
    rng = random.Random(5)
    pairs = [(rng.randrange(50), rng.randrange(50)) for _ in range(130)] + [(a, b) for a in range(100, 110) for b in range(110, 125)] + [(i, i + 1) for i in range(200, 223)]
    df = spark.createDataFrame([(a, b, 2.5) for a, b in pairs], EDGES)
    want = {r.node: r.betweenness for r in graph.betweenness(df).collect()}
    written, settled = [], graph.settled
    monkeypatch.setattr(graph, "settled", lambda *a: written.append(settled(*a)) or written[-1])
    got = {r.node: (r.betweenness, r.error) for r in graph.sampled_betweenness(df, 1000).collect()}
    assert got == {k: (pytest.approx(v, abs=1e-6), 0.0) for k, v in want.items()} and len(want) > 2 * graph._SIDE_BY_SIDE
    # a row for each edge, or for each node and block of sources, but none for a source and an arc
    assert max(t.count() for t in written) <= max(len(pairs), len(want) * -(-len(want) // graph._SIDE_BY_SIDE))
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_equal_lengths_are_not_kept_with_the_edges(spark, monkeypatch):
    """What is held for all rounds is the two ends of an edge, its starts as runs."""
    held, by_hops = [], graph._parts_by_hops
    monkeypatch.setattr(graph, "_parts_by_hops", lambda e, *a: held.append((e.columns, e.groupBy(F.spark_partition_id()).agg(F.collect_list("u").alias("us")).collect())) or by_hops(e, *a))
    df = spark.createDataFrame([(k % 50, 100 + k % 37, 1.0) for k in range(300)], EDGES)
    want = {r.node: r.betweenness for r in graph.betweenness(df).collect()}
    assert {r.node: r.betweenness for r in graph.sampled_betweenness(df, 1000).collect()} == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}
    columns, parts = held[0]
    assert columns == ["u", "v"] and all(list(r.us) == sorted(r.us) for r in parts)
