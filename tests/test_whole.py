"""Queries that must read whole tables, and operators that must not stop early."""

from __future__ import annotations

import datetime as dt

import differential
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import fuzzy, graph, joins, linkage
from ledgerline.queries import links, rows, rulesets, sums, wholes

from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return differential.duck(SMALL)


@pytest.fixture(scope="module")
def edges(con):
    """(src, dst): weight of every nation pair."""
    sql = "SELECT s_nationkey, c_nationkey, count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
    return {(a, b): n for a, b, n in con.sql(sql).fetchall()}


def test_pagerank_reads_every_edge(spark, edges):
    nodes = sorted({x for e in edges for x in e})
    total = {n: sum(w for (s, _), w in edges.items() if s == n) for n in nodes}
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(300):
        lost = sum(rank[n] for n in nodes if not total[n])
        rank = {n: 0.15 / len(nodes) + 0.85 * (sum(rank[s] * w / total[s] for (s, d), w in edges.items() if d == n) + lost / len(nodes)) for n in nodes}
    got = {r.node: r["rank"] for r in wholes.pagerank(spark, SMALL).collect()}
    assert got == pytest.approx(rank, abs=2e-8)


def test_betweenness_reads_every_edge(spark, edges):
    length = {}
    for (a, b), w in edges.items():
        if a != b:
            k = (min(a, b), max(a, b))
            length[k] = min(w, length.get(k, w))
    nodes = sorted({x for e in length for x in e})
    dist = {(a, b): 0 if a == b else length.get((min(a, b), max(a, b)), float("inf")) for a in nodes for b in nodes}
    for m in nodes:
        for a in nodes:
            for b in nodes:
                dist[a, b] = min(dist[a, b], dist[a, m] + dist[m, b])
    count = {}
    for a in nodes:  # numbers of shortest paths, nearest first
        count[a, a] = 1
        for b in sorted(nodes, key=lambda b: dist[a, b]):
            if b != a:
                count[a, b] = sum(count.get((a, m), 0) for m in nodes if m != b and (k := (min(m, b), max(m, b))) in length and dist[a, m] + length[k] == dist[a, b])
    want = {
        v: sum(count[s, v] * count[v, t] / count[s, t] for s in nodes for t in nodes if s < t and v not in (s, t) and count[s, t] and dist[s, v] + dist[v, t] == dist[s, t]) for v in nodes
    }
    got = {r.node: r.betweenness for r in wholes.betweenness(spark, SMALL).collect()}
    assert got == pytest.approx(want, abs=2e-6)


def test_whole_graph_queries_see_every_pair(spark, edges):
    got = {r.node: (r.n_out, r.n_in) for r in wholes.edge_metrics(spark, SMALL).collect()}
    assert got == {n: (sum(s == n for s, _ in edges), sum(d == n for _, d in edges)) for n in {x for e in edges for x in e}}
    one = {(r.origin, r.terminal) for r in wholes.flow_paths(spark, SMALL).filter("hops = 1").collect()}
    assert one == {e for e in edges if e[0] != e[1]}


def test_fuzzy_best_reads_every_part(spark, con):
    sets = {k: frozenset(t.split()) for k, t in con.sql("SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type FROM part").fetchall()}
    want = {}
    for a, x in sets.items():
        score, b = max((len(x & y) / len(x | y), -b) for b, y in sets.items() if b != a)
        if score >= 0.6:
            want[a] = (-b, round(score, 4))
    assert {r.vendor: (r.registered, r.score) for r in rows.fuzzy_best(spark, SMALL).collect()} == want
    assert any(a % 20 or b % 20 != 7 for a, (b, _) in want.items())


def test_jaccard_best_other_with_copies(spark):
    texts = ["a b c", "c b a", "a b c", "a b d", "x", "", ""]
    df = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "i int, w array<string>")
    got = {r.i: (r.j, r.score) for r in joins.jaccard_best_other(df, "i", "w", "j", 0.5).collect()}
    assert got == {0: (1, 1.0), 1: (0, 1.0), 2: (0, 1.0), 3: (0, 0.5)}


def test_overlap_join_reads_every_part(spark, con):
    p = con.sql("SELECT p_partkey, p_brand, p_retailprice FROM part").fetchall()
    want = {(a, b) for a, r, lo in p for b, q, s in p if a != b and r == q and (min(lo + 30, s + 12.5) - max(lo, s)) / 12.5 >= 0.2}
    assert {(r.project, r.segment) for r in rows.overlap_join(spark, SMALL).collect()} == want


def test_overlap_join_is_dealt_to_many_tasks(spark):
    assert rows.overlap_join(spark, SMALL).select(F.spark_partition_id().alias("task")).distinct().count() > 4


def test_overlap_of_copies_in_blocks_is_all_pairs_once(spark):
    ends = [(0.0, 10.0), (0.0, 10.0), (4.0, 5.0), (9.0, 30.0), (7.0, 3.0), (None, 2.0), (40.0, 41.0)]
    a = [(r, 100 * k + i, *x) for r in ("R", "Q", None) for k, x in enumerate(ends[:-1]) for i in range(13)]
    b = [(r, 100 * k + i, *x) for r in ("R", "S", None) for k, x in enumerate(ends) for i in range(11)]
    left, right = spark.createDataFrame(a, "r string, p int, lo double, hi double"), spark.createDataFrame(b, "r string, s int, slo double, shi double")
    both = [(x, y) for x in a for y in b if x[0] and x[0] == y[0] and None not in x + y and x[2] <= y[3] and y[2] <= x[3]]
    want = sorted((x[1], y[1], max(x[2], y[2])) for x, y in both)
    for block in (1, 4, 20_000):
        got = joins.overlap(left, right, "r", "lo", "hi", "slo", "shi", 6.0, {"begins": F.greatest("lo", "slo")}, block)
        assert sorted((x.p, x.s, x.begins) for x in got.collect()) == want and want


NAMES = ["ACME", "ACMFF", "ACME CONSTRUCTION GROUP", "CONSTRUCTION GROUP ACME", "BETA SUPPLY CO", "BETA SUPLY CO", "OMEGA", "PRASA", "", "GAMMA TRUST"]
OTHERS = ["ACME CONSTRUCTION GROUP", "ACMF", "BETA SUPPLY", "GAMMA TRUSTS", "OMEGA", "DELTA"]


def _frames(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "n string"), spark.createDataFrame([(n,) for n in OTHERS], "o string")


def test_best_name_takes_the_higher_score_of_all_pairs(spark):
    want = {}
    for a in filter(None, NAMES):
        score, b = min((-fuzzy.name_score(a, b), b) for b in OTHERS)
        if -score >= 0.75:
            want[a] = (b, pytest.approx(-score))
    left, right = _frames(spark)
    got = {r.n: (r.o, r.score) for r in fuzzy.best_name(left, right, "n", "o", 0.75).collect()}
    assert got == want and got["ACME"] == ("ACME CONSTRUCTION GROUP", 1.0) and got["ACMFF"] == ("ACMF", pytest.approx(8 / 9))


def test_exact_then_fuzzy_by_sequence_ratio(spark):
    from difflib import SequenceMatcher

    want = {}
    for a in filter(None, NAMES):
        score, b = min((-SequenceMatcher(None, a, b).ratio(), b) for b in OTHERS)
        want[a] = (a, "exact") if a in OTHERS else (b, "fuzzy") if -score >= 0.85 else (None, "none")
    left, right = _frames(spark)
    assert {r.n: (r.o, r.method) for r in fuzzy.exact_then_fuzzy(left, right, "n", "o").collect()} == want
    assert {m for _, m in want.values()} == {"exact", "fuzzy", "none"}


def test_matched_before_joins_by_score_and_time(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    posted = [(i, n, day(200 + i)) for i, n in enumerate(NAMES)]
    filed = [(j, n, day(d)) for j, (n, d) in enumerate((n, d) for n in OTHERS for d in (10, 30, 199, 205, 300))]
    left, right = spark.createDataFrame(posted, "p int, n string, t timestamp"), spark.createDataFrame(filed, "f int, o string, u timestamp")
    want = {(p, f) for p, n, t in posted for f, o, u in filed if fuzzy.name_score(n, o) >= 0.7 and t - dt.timedelta(days=180) <= u <= t}
    assert {(r.p, r.f) for r in fuzzy.matched_before(left, right, "n", "o", "t", "u", 180).collect()} == want and want


def test_matched_over_columns_takes_the_maximum(spark):
    left = spark.createDataFrame([(1, "ACME DE PR GROUP"), (2, "DE PR")], "i int, n string")
    right = spark.createDataFrame([(7, "BETA", "ACME GROUP"), (8, "GROUP ACME", None), (9, "DE PR", "ACME")], "j int, a string, b string")
    assert sorted(tuple(r) for r in fuzzy.matched_over_columns(left, right, "i", "j", "n", ["a", "b"]).collect()) == [(1, 7, 1.0), (1, 8, 1.0)]


def test_corridor_promotes_projects_without_measures(spark):
    p = spark.createDataFrame([(1, "R", 0.0, 4.0), (2, "R", None, None), (3, "R", 5.0, None), (4, "R", 9.0, 2.0), (5, "Q", None, None)], "p int, r string, lo double, hi double")
    s = spark.createDataFrame([(1, "R", 0.0, 10.0), (2, "R", 3.5, 8.5), (3, "R", 8.0, 9.0)], "s int, r string, slo double, shi double")
    got = sorted((r.p, r.s, r.share, r.method) for r in joins.corridor(p, s, "p", "s", "r", 5.0).collect())
    assert got == [(1, 1, 0.4, "route_km_measure"), *[(2, k, 0.0, "route_only_promoted") for k in (1, 2, 3)]]


def test_superseded_replaces_all_prior_filings(spark):
    rows_ = [("h", 1, "a", False), ("h", 1, "a", False), ("h", 2, "b", False), ("h", 3, "c", True), ("h", 3, "d", False), ("h", 4, "e", False), ("g", 1, "f", True)]
    df = spark.createDataFrame(rows_, "h string, t int, f string, r boolean")
    assert sorted((r.f, r.superseded) for r in linkage.superseded(df, ["h"], "t", "f", F.col("r")).collect()) == [
        ("a", True), ("a", True), ("b", True), ("c", False), ("d", False), ("e", False), ("f", False)
    ]
    with pytest.raises(Exception, match="inconsistent"):
        linkage.superseded(spark.createDataFrame([*rows_, ("h", 9, "a", False)], df.schema), ["h"], "t", "f", F.col("r")).collect()


def test_cycles_of_any_length(spark):
    e = spark.createDataFrame([(i, (i + 1) % 7) for i in range(7)] + [(3, 20), (20, 21), (30, 30)], "src int, dst int")
    assert sorted(tuple(r) for r in graph.cycles(e).collect()) == [*((i, 7) for i in range(7)), (30, 1)]


def test_whole_cycle_check_reads_every_edge(spark, edges):
    after = {}
    for s, d in edges:
        after.setdefault(s, set()).add(d)
    want = {}
    for s in after:
        front, seen, hop = after[s], set(), 1
        while front and s not in front:
            seen |= front
            front, hop = {y for x in front for y in after.get(x, ())} - seen, hop + 1
        if front:
            want[s] = hop
    assert {r.node: r.hops for r in wholes.cycle_check(spark, SMALL).collect()} == want


def test_waves_of_a_long_chain(spark):
    nodes = spark.createDataFrame([(i,) for i in range(56)], "node int").coalesce(1)
    needs = spark.createDataFrame([(i, i - 1) for i in range(1, 53)] + [(54, 55), (55, 54), (53, 54)], "node int, needs int").coalesce(1)
    got = {r.node: r.wave for r in linkage.waves(needs, nodes).collect()}
    assert got == {i: i if i < 53 else None for i in range(56)}


def test_pagerank_converges(spark):
    pairs = [(0, 1), (1, 0), (1, 2), (2, 1), (2, 3), (3, 2), (3, 0), (0, 4), (4, 5), (5, 6), (6, 4)]  # a ring of three drains the rest slowly
    rank = dict.fromkeys(range(7), 1 / 7)
    for _ in range(1000):
        rank = {n: 0.15 / 7 + 0.85 * sum(rank[s] / sum(x == s for x, _ in pairs) for s, d in pairs if d == n) for n in range(7)}
    e = spark.createDataFrame([(s, d, 1.0) for s, d in pairs], "src int, dst int, weight double").coalesce(1)
    assert {r.node: r["rank"] for r in graph.pagerank(e).collect()} == pytest.approx(rank, abs=1e-8)
    with pytest.raises(ValueError):
        graph.pagerank(e, most=5)


def test_encoding_looks_at_the_whole_file(spark, tmp_path):
    from ledgerline.sources import readers

    late = b"x" * (1 << 20) + "\nPe\u00f1a\n".encode("latin-1")
    (tmp_path / "late.csv").write_bytes(late)
    (tmp_path / "good.csv").write_bytes(b"x" * (1 << 20) + "\nPe\u00f1a\n".encode())
    assert readers.encoding_of(spark, str(tmp_path / "late.csv")) == "ISO-8859-1"
    assert readers.encoding_of(spark, str(tmp_path / "good.csv")) == "UTF-8"


def test_layers_and_bridge_read_every_nation(spark, con):
    sides = {k: {x for (x,) in con.sql(f"SELECT {c} FROM {k}").fetchall()} for k, c in (("customer", "c_nationkey"), ("nation", "n_nationkey"), ("supplier", "s_nationkey"))}
    want = {n: "|".join(k for k in sides if n in sides[k]) for n in set().union(*sides.values())}
    assert {r.subject: r.domains for r in rulesets.cross_layers(spark, SMALL).collect()} == {n: d for n, d in want.items() if "|" in d}
    assert {r.nation for r in rows.outer_bridge(spark, SMALL).collect()} == sides["customer"] | sides["supplier"]


def test_overlap_and_snapshot_read_every_row(spark, con):
    n = {t: con.sql(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in ("customer", "supplier")}
    r = sums.set_overlap(spark, SMALL).first()
    assert (r.left_rows, r.right_rows) == (n["customer"], n["supplier"])
    keys = {k for (k,) in con.sql("SELECT c_custkey FROM customer UNION SELECT s_suppkey FROM supplier").fetchall()}
    assert {r.k for r in links.snapshot_merge(spark, SMALL).collect()} == keys
