"""Operators, graphs, sources, sinks and streams on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregates, checks, dedup, graph, joins
from ledgerline.plans import products
from ledgerline.sources import readers, sinks
from ledgerline.streaming import incremental


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_per_key_survives_repartition(spark):
    df = spark.createDataFrame([(i % 7, i, "" if i % 5 == 0 else "x") for i in range(200)], "k int, o int, b string")
    want = rows(dedup.first_per_key(df, ["k"], [F.col("o")], "b"))
    assert rows(dedup.first_per_key(df.repartition(13), ["k"], [F.col("o")], "b")) == want
    assert rows(dedup.best_per_key(df, ["k"], [F.col("o")])) == [(k, k, "" if k % 5 == 0 else "x") for k in range(7)]


def test_band_is_all_pairs_in_range(spark):
    at = dt.datetime(2024, 1, 1)
    a = [(1, i, at + dt.timedelta(minutes=7 * i)) for i in range(40)]
    b = [(1, at + dt.timedelta(minutes=11 * i)) for i in range(30)]
    left = spark.createDataFrame(a, "k int, i int, t timestamp")
    right = spark.createDataFrame(b, "k int, u timestamp")
    for before, after in ((1200, 0), (600, 300), (0, 0)):
        got = joins.band(left, right, ["k"], "t", "u", before, after).count()
        assert got == sum(x[2] - dt.timedelta(seconds=before) <= y[1] <= x[2] + dt.timedelta(seconds=after) for x in a for y in b)


def test_overlap_is_all_pairs_once(spark):
    a = [(1, i, 3.0 * i, 3.0 * i + 10) for i in range(20)]
    b = [(1, i, 5.0 * i, 5.0 * i + 2.5) for i in range(20)]
    left, right = spark.createDataFrame(a, "r int, p int, lo double, hi double"), spark.createDataFrame(b, "r int, s int, slo double, shi double")
    got = joins.overlap(left, right, "r", "lo", "hi", "slo", "shi", 4.0).select("p", "s")
    assert rows(got) == sorted((x[1], y[1]) for x in a for y in b if x[2] <= y[3] and y[2] <= x[3])


def test_asof_strict_and_ties(spark):
    at = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, at), (1, at + dt.timedelta(hours=2)), (2, at)], "k int, t timestamp")
    right = spark.createDataFrame([(1, at, 5), (1, at, 4), (1, at + dt.timedelta(hours=1), 6)], "k int, u timestamp, v int")
    got = joins.asof_before(left, right, ["k"], "t", "u", "v", "v").select("k", "t", "asof_value")
    assert sorted((r.k, r.t, r.asof_value or 0) for r in got.collect()) == [(1, at, 0), (1, at + dt.timedelta(hours=2), 6), (2, at, 0)]
    loose = joins.asof_before(left, right, ["k"], "t", "u", "v", "v", strict=False)
    assert {r.asof_value for r in loose.filter("k = 1").collect()} == {4, 6}


def test_jaccard_best_misses_nothing(spark):
    import random

    rng = random.Random(1)
    sets = [sorted({f"w{rng.randrange(12)}" for _ in range(rng.randrange(1, 6))}) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sets)), "i int, w array<string>")
    right = df.withColumnsRenamed({"i": "j", "w": "x"})
    got = {r.i: (r.j, round(r.score, 6)) for r in joins.jaccard_best(df, right.filter("j % 2 = 1"), "i", "j", "w", "x", 0.5).collect()}
    for i, a in enumerate(sets):
        best = max(((len(set(a) & set(b)) / len(set(a) | set(b)), -j) for j, b in enumerate(sets) if j % 2))
        assert got.get(i) == ((-best[1], round(best[0], 6)) if best[0] >= 0.5 else None)


def test_ranks_without_one_task(spark):
    values = [(i, float((i * 7919) % 500)) for i in range(3000)]
    df = spark.createDataFrame(values, "k int, x double").repartition(9)
    got = {r.k: r["rank"] for r in products.ranked(df, "x", "k", cells=16).collect()}
    assert got == {k: n for n, (k, _) in enumerate(sorted(values, key=lambda v: (-v[1], v[0])), 1)}


def test_quarantine_and_split_lose_nothing(spark):
    df = spark.createDataFrame([("Acme", 0.95), (" unknown ", 0.5), (None, None)], "name string, c double")
    kept, bad = products.quarantine(df, "name")
    assert kept.count() == 2 and bad.count() == 1  # blank names stay: only the ten tokens of the survey go
    linked, review = products.split_review(df, "c")
    assert linked.count() == 1 and review.count() == 2


def test_pagerank_plain_version(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "c", 1.0), ("c", "e", 3.0)]
    got = {r.node: r["rank"] for r in graph.pagerank(spark.createDataFrame(edges, "src string, dst string, weight double"), rounds=12).collect()}
    nodes = sorted({x for e in edges for x in e[:2]})
    total = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(12):
        lost = sum(rank[n] for n in nodes if not total[n])
        rank = {n: 0.15 / 5 + 0.85 * (sum(rank[s] * w / total[s] for s, d, w in edges if d == n) + lost / 5) for n in nodes}
    assert got == pytest.approx(rank) and sum(got.values()) == pytest.approx(1)


def test_betweenness_of_known_graphs(spark):
    path = [(i, i + 1, 1.0) for i in range(4)]
    got = {r.node: r.betweenness for r in graph.betweenness(spark.createDataFrame(path, "src int, dst int, weight double")).collect()}
    assert got == {0: 0, 1: 3, 2: 4, 3: 3, 4: 0}
    square = [(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (3, 0, 1.0)]
    got = {r.node: r.betweenness for r in graph.betweenness(spark.createDataFrame(square, "src int, dst int, weight double")).collect()}
    assert got == pytest.approx(dict.fromkeys(range(4), 0.5))
    with pytest.raises(ValueError):
        graph.betweenness(spark.createDataFrame(path, "src int, dst int, weight double"), max_nodes=3)


def test_paths_cycles_and_faults(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = rows(graph.simple_paths(e, spark.createDataFrame([("a",)], "node string"), 3).select("path"))
    assert got == [("a > b",), ("a > b > c",), ("a > b > c > d",)]
    assert rows(graph.cycles(e, 3)) == [("a", 3), ("b", 3), ("c", 3)]


def test_chain_and_upsert(spark):
    log = checks.chain(spark.createDataFrame([(1, i, f"p{i}") for i in range(4)], "g int, n int, p string"), "g", "n", F.col("p"))
    assert checks.chain_faults(log, "g", "n").count() == 0
    bad = log.filter("n <> 1")
    assert rows(checks.chain_faults(bad, "g", "n").select("n", "fault")) == [(2, "hash")]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(checks.upsert_plan(old, new, ["k"], ["v"])) == [(1, "missing"), (2, "update"), (3, "insert")]
    assert checks.upserted(old, new, ["k"]).count() == 3


def test_reconcile_and_contradictions(spark):
    p = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, 0.0)], "k int, r double")
    c = spark.createDataFrame([(1, 100.5), (2, 80.0), (3, 5.0)], "k int, a double")
    assert rows(aggregates.reconcile(p, c, "k", "r", "a").select("k", "status")) == [(1, "OK"), (2, "FAIL"), (3, "OK")]
    claims = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a")], "k int, v string")
    assert aggregates.contradictions(claims, ["k"], "v").count() == 2


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿Name,Amount\n\"Acme, Inc\",\"$1\"\n".encode())
    df = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Name", "Amount"] and df.first().Name == "Acme, Inc"
    assert readers.read_csv(spark, str(tmp_path / "none.csv"), ["x"], missing_ok=True).count() == 0
    (tmp_path / "l.csv").write_bytes("Name\nPeña\n".encode("latin-1"))
    assert readers.encoding_of(spark, str(tmp_path / "l.csv")) == "ISO-8859-1"
    with pytest.raises(ValueError):
        readers.guarded(spark, [str(tmp_path / "fixture.csv")])
    sinks.write(df, str(tmp_path / "out"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "out")).count() == 1
    assert not sinks.write(df, str(tmp_path / "out"), "csv", force=False)
    a, b = sinks.manifest(df, "x").first(), sinks.manifest(df.repartition(3), "x").first()
    assert a == b and a.n_rows == 1
    (tmp_path / "j.jsonl").write_text('{"a": 1}\nbroken\n')
    good, broken = readers.read_jsonl(spark, str(tmp_path / "j.jsonl"), spark.createDataFrame([], "a long").schema)
    assert good.count() == 1 and rows(broken) == [("broken",)]
    (tmp_path / "x.xml").write_text('<l xmlns="u:x"><e><n>A</n><k>1</k></e><e><n>B</n><k>2</k></e></l>')
    assert readers.read_xml(spark, str(tmp_path / "x.xml"), "e").count() == 2
    nested = spark.range(1).select(F.struct(F.lit(1).alias("b"), F.struct(F.lit(2).alias("d")).alias("c")).alias("a"))
    assert readers.flatten(nested).columns == ["a.b", "a.c.d"]
    assert readers.conform(df, {"recipient": ["vendor", "name"], "uei": ["uei"]}).first() == ("Acme, Inc", "")
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("INFOTABLE.tsv", "A\tB\n1\t2\n")
    assert rows(readers.read_zip_members(spark, str(tmp_path / "z.zip"), ".tsv").select("cells")) == [(["1", "2"],), (["A", "B"],)]
    lines = sinks.graphml(spark.createDataFrame([("a&b",)], "node string"), spark.createDataFrame([("a&b", "c", 1.0)], "src string, dst string, weight double"))
    import xml.etree.ElementTree as ET

    assert len(ET.fromstring("".join(r.line for r in lines.collect()).split("?>")[1])) == 2
    assert "| Acme, Inc |" in sinks.markdown("r", {"s": df})


def test_new_files_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "b.txt").write_text("x")
    files = readers.inventory(spark, str(tmp_path))
    first = readers.new_files(files, spark.createDataFrame([], "sha256 string"))
    assert first.count() == 1 and readers.new_files(files, first).count() == 0


def test_adapters_isolate_failures(spark):
    a = readers.Adapters()
    a.register("good", lambda s, q: s.range(q["n"]))
    a.register("bad", lambda s, q: 1 / 0)
    union, outcomes = a.run(spark, {"n": 3}, ["good", "bad", "other"])
    assert union.count() == 3 and [o["status"] for o in outcomes] == ["ok", "error", "manual_only"]


def test_stream_upsert(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    df.write.parquet(folder)
    sink = incremental.upsert_into(out, ["k"])
    incremental.run_available(incremental.events(spark, folder, df.schema), str(tmp_path / "state"), sink)
    spark.createDataFrame([(2, "c")], "k int, v string").write.mode("append").parquet(folder)
    incremental.run_available(incremental.events(spark, folder, df.schema), str(tmp_path / "state"), sink)
    assert rows(spark.read.parquet(f"{out}/v=1").select("k", "v")) == [(1, "a"), (2, "c")]


def test_cascade_place_and_waves(spark):
    from ledgerline.operators import linkage

    df = spark.createDataFrame([(1, "a", "x"), (2, "", "y"), (3, None, "q")], "r int, id string, n string")
    t = spark.createDataFrame([("a", "x", 7), ("b", "y", 8), ("", "z", 9)], "id string, n string, v int")
    got = rows(linkage.cascade(df, "r", [("id", t, "id", 0.9), ("name", t, "n", 0.7)], "v").select("r", F.coalesce("v", F.lit(0)), "matched_by"))
    assert got == [(1, 7, "id"), (2, 8, "name"), (3, 0, "none")]
    nodes = spark.createDataFrame([(i,) for i in range(5)], "node int")
    needs = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, 4), (4, 3)], "node int, needs int")
    got = {r.node: r.wave for r in linkage.waves(needs, nodes).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: None, 4: None}


def test_edges_or_reasons(spark):
    from ledgerline.operators import edges

    n = spark.createDataFrame([("n1", "A"), ("n2", "B")], "node string, name string")
    index = edges.name_index([(n, "node", F.array("name"))])
    r = spark.createDataFrame(
        [("A", "funds", "B", "e", 0.9), ("A", "funds", "A", "e", 0.9), ("A", "x", "B", "e", 0.9), ("A", "funds", "C", "e", 0.9), ("A", "funds", "B", None, 0.9)],
        "source string, verb string, target string, evidence string, confidence double",
    )
    good, bad = edges.build(r, index, ["funds"])
    assert good.count() == 1 and rows(bad.select("reason")) == [("bad_verb",), ("no_evidence",), ("self_loop",), ("unresolved_target",)]


def test_cache_is_read_through(spark, tmp_path):
    from ledgerline.sources.cache import cached, query_hash

    calls = []

    def fetch():
        calls.append(1)
        return spark.range(3)

    q = {"county": ["b", "a"], "year": 2020}
    assert query_hash(q) == query_hash({"year": 2020, "county": ["a", "b"], "agency": None})
    for now in (1000.0, 2000.0, 1000.0 + 90_000):
        assert cached(spark, str(tmp_path), "s", q, "daily", fetch, now).count() == 3
    assert len(calls) == 2


def test_paged_source_pushes_filters(spark):
    import paged_pages

    from ledgerline.sources.paged import PagedSource, with_retries

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged").schema("county string, amount double, year int").options(fetcher="paged_pages:fetch", pages="9", per_task="2").load()
    every = [r for p in range(1, 8) for r in paged_pages.fetch(p, {})]
    assert df.count() == 70
    got = df.filter("county = '72001' AND year >= 2003 AND amount < 55")
    assert got.count() == sum(r["county"] == "72001" and r["year"] >= 2003 and r["amount"] < 55 for r in every)
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return 5

    assert with_retries(flaky, sleep=lambda s: None) == 5
    with pytest.raises(ZeroDivisionError):
        with_retries(lambda: 1 / 0, tries=2, sleep=lambda s: None)


def test_html_tables_and_text(spark):
    from ledgerline.sources import html

    page = "<p>x</p><script>var a='<b>';</script><table><tr><th>A</th><th>B &amp; C</th></tr><tr><td> 1 <b>2</b></td><td>3</td></tr></table><!-- no -->"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, h string")
    assert rows(html.tables(df, "id", "h").select("id", "row", "cells")) == [(1, 0, ["A", "B & C"]), (1, 1, ["1 2", "3"])]
    assert df.select(html.plain_text(F.col("h"))).first()[0] == "x A B & C 1 2 3"


def test_due_and_planned(spark):
    from ledgerline.streaming import updates

    at = dt.datetime(2024, 1, 10)
    policies = spark.createDataFrame([("a", "daily"), ("b", "yearly"), ("c", "yearly"), ("d", "never")], "source string, cadence string")
    state = spark.createDataFrame(
        [("a", at - dt.timedelta(days=2), "h1", {}), ("b", at - dt.timedelta(days=2), "h2", {"a": "h0"}), ("d", at - dt.timedelta(days=900), "h3", {})],
        "source string, fetched_at timestamp, content_hash string, consumed map<string,string>",
    )
    needs = spark.createDataFrame([("b", "a"), ("c", "b")], "source string, parent string")
    found = updates.due(policies, state, needs, F.lit(at))
    assert rows(found) == [("a", "stale"), ("b", "parent_changed"), ("c", "never_fetched")]
    assert rows(updates.plan(found, needs).select("source", "wave")) == [("a", 0), ("b", 1), ("c", 2)]
