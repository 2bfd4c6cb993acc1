"""Chains, components, cycles, filings and entity resolution against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import graph
from ledgerline.plans import filings, resolution


def _edges(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long")


def test_long_chain_in_few_rounds(spark, monkeypatch):
    rounds = []
    true = graph.settled
    monkeypatch.setattr(graph, "settled", lambda df, name: (rounds.append(name), true(df, name))[1])
    links = [(k, k + 1 if k < 60 else None) for k in range(1, 61)]
    got = {r.node: (r.last, r.hops, r.cycle) for r in graph.chains(spark.createDataFrame(links, "node long, next long")).collect()}
    assert got == {k: (60, 60 - k, None) for k in range(1, 61)}
    # links and two states at first, then a step and what is done in each round
    assert len(rounds) <= 3 + 2 * 7


def test_chains_and_circles(spark):
    rng = random.Random(5)
    n = 400
    nxt = {k: rng.randrange(n) if rng.random() < 0.97 else None for k in range(n)}
    nxt[0], nxt[1], nxt[2] = 0, 2, 10_000  # a circle of one; an end that is no node
    got = {r.node: (r.last, r.hops, r.cycle) for r in graph.chains(spark.createDataFrame(list(nxt.items()), "node long, next long")).collect()}
    for k in range(n):
        seen, at = [], k
        while at is not None and at not in seen:
            seen.append(at)
            at = nxt.get(at)
        want = (seen[-1], len(seen) - 1, None) if at is None else (None, None, min(seen[seen.index(at) :]))
        assert got[k] == want
    assert any(c for _, _, c in got.values()) and len({c for _, _, c in got.values()}) > 2
    assert graph.chains(spark.createDataFrame([], "node long, next long")).count() == 0


def _reach(edges):
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    found = {}
    for a in list(out):
        seen, todo = set(), [a]
        while todo:
            for y in out[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        found[a] = seen
    return found


@pytest.mark.parametrize("n,m,seed", [(60, 70, 1), (60, 110, 2), (200, 210, 3)])
def test_strong_components(spark, n, m, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1000 + k, 1001 + k) for k in range(30)] + [(5, 5), (2000, 2000), (None, 3)]
    reach = _reach([e for e in edges if e[0] is not None])
    want = {a: min(b for b in reach[a] | {a} if a in reach.get(b, ())) for a in reach if a in reach[a]}
    got = {r.node: r.component for r in graph.strong_components(_edges(spark, edges)).collect()}
    assert got == want and 2000 in got and 1010 not in got


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(500, 620)] + [(900, k) for k in range(901, 960)] + [(None, 1)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges[:-1]:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.component for r in graph.components(_edges(spark, edges)).collect()}
    assert got == {x: root(x) for x in parent}
    assert graph.components(_edges(spark, [])).count() == 0


def test_filing_reasons(spark):
    rows = [
        ("a", "2024-01-01", None, "13F", None), ("b", "2024-02-01", None, "13F", "a"), ("c", "2024-03-01", None, "13F", "b"),
        ("d", "2024-01-01", None, "10K", None), ("e", "2024-01-01", "2024-02-01", "13F", None), ("f", "2024-01-01", None, None, None),
        ("x", "2024-01-01", None, "13F", "y"), ("y", "2024-01-02", None, "13F", "x"),
        ("p", "2024-01-01", None, "13F", None), ("q", "2024-01-02", None, "13F", "p"), ("r", "2024-01-03", None, "13F", "p"),
        ("g", "2024-01-01", None, "13F", "nowhere"), ("h", "2024-01-01", None, "13F", None), ("h", "2024-01-01", None, "13F", None), (None, "2024-01-01", None, "13F", None),
    ]
    df = spark.createDataFrame(rows, "filing string, at string, reported string, form string, replaces string")
    out = filings.denominator(df, "filing", "replaces", "at", "reported", ["form"], F.col("form") == "13F")
    got = {r.filing: (r.state, r.reason, r["last"], r.hops) for r in out.collect()}
    assert got["a"] == ("excluded", "SUPERSEDED", "c", 2) and got["b"][1] == "SUPERSEDED" and got["c"] == ("retained", None, "c", 0)
    assert got["d"][1] == "FORM_TYPE_OUT_OF_SCOPE" and got["e"][1] == "FILED_BEFORE_PERIOD" and got["f"][1] == "MISSING_FIELD" and got[None][1] == "MISSING_FIELD"
    assert got["x"][1] == got["y"][1] == "REPLACEMENT_CYCLE" and got["h"][1] == "DUPLICATE_FILING"
    assert got["p"] == ("excluded", "REPLACEMENT_CONFLICT", "r", 1) and got["q"][0] == got["r"][0] == got["g"][0] == "retained"
    counts = filings.tally(out).collect()
    assert sum(r.filings for r in counts) == len(rows)
    place = {r.filing: r.place for r in filings.placed(out, [], "at", "filing").filter("state = 'retained'").collect()}
    assert [f for f, _ in sorted(place.items(), key=lambda x: x[1])] == ["g", "q", "r", "c"]


SCHEMA = """record string, name string, aliases array<string>, address string, phone string, officers array<string>, parent string, contracts array<string>,
clients array<string>, valid_from int, valid_to int, municipality string, project string, ids map<string,string>"""


def _record(name, ids=None, **more):
    base = dict(aliases=[], address="1 CALLE SOL", phone="7875550000", officers=["P"], parent=None, contracts=["K"], clients=[], valid_from=2000, valid_to=2010, municipality="m", project="p")
    base |= more
    return (*(base[c] for c in ("aliases", "address", "phone", "officers", "parent", "contracts", "clients", "valid_from", "valid_to", "municipality", "project")), ids or {}), name


def _records(spark, *rows):
    return spark.createDataFrame([(str(k), name, *rest) for k, (rest, name) in enumerate(rows)], SCHEMA)


def test_pairs_come_up_once(spark):
    rng = random.Random(3)
    rows = [_record(" ".join(rng.choice(["ALPHA", "BETA", "GAMMA", "DELTA", "INC"]) for _ in range(3)), {"uei": f"U{rng.randrange(30)}"}, phone=f"{rng.randrange(40)}", address=f"STREET {rng.randrange(25)}") for _ in range(120)]
    rows.append(_record(None, None, address=None, phone=None))
    df = _records(spark, *rows)
    keys = {r.record: set(r["keys"]) for r in resolution.keyed(df).collect()}
    assert keys["120"] == set()
    size = Counter(k for own in keys.values() for k in own)
    for limit in (1000, 15):
        wide = {k for k, n in size.items() if n > limit}
        assert {r.key for r in resolution.wide_keys(df, limit).collect()} == wide
        got = [(r.a, r.b) for r in resolution.pairs(df, limit).collect()]
        assert len(got) == len(set(got))
        two = Counter((x, y) for own in keys.values() for x in own & wide for y in own & wide if x < y)
        want, first = set(), {}
        for a in sorted(keys):
            for b in sorted(keys):
                if a < b:
                    both = keys[a] & keys[b]
                    if both - wide or any(two[x, y] <= limit for x in both & wide for y in both & wide if x < y):
                        want.add((a, b))
        for pair in (p for p, n in two.items() if n > limit):
            members = sorted(r for r, own in keys.items() if set(pair) <= own)
            want |= {(members[0], m) for m in members[1:]}
        assert set(got) == want
    assert resolution.pairs(df.limit(0)).count() == 0


def test_all_features_count(spark):
    same = _record("ACME", {"uei": "U1"}, aliases=["ACME PR"], clients=["L"])
    df = _records(spark, same, (same[0], "ACME"), _record("ACME", {"uei": "U2"}, aliases=["ACME"], parent="0", clients=["L"]), _record("OTHER", {"vendor_id": "U1"}, address="9 LUNA", phone="1", officers=[], contracts=[], valid_from=2020, valid_to=2021, municipality="n"))
    got = {(r.a, r.b): r for r in resolution.decisions(df).collect()}
    twin = got["0", "1"]
    assert (twin.score, twin.decision, twin.shares_id, twin.disagrees) == (1.0, "auto_merge", True, False)
    # everything but the identifier: strong, and yet no merge
    rival = got["0", "2"]
    assert rival.decision == "suggested_merge" and rival.disagrees and not rival.exact_id and rival.parent and rival.alias and rival.lobby and rival.municipality and rival.temporal
    assert ("0", "3") not in got  # a number of no authority is no key


def test_no_entity_holds_two_identifiers(spark):
    rows = [
        _record("ACME ONE", {"uei": "U1", "ein": "E1"}), _record("ACME ONE", {"uei": "U1"}), _record("ACME ONE", {"ein": "E1"}),
        _record("ACME ONE", {"uei": "U2", "ein": "E1"}), _record("BOLT", {"cage": "C"}, address="x"), _record("BOLT", {"cage": "C"}, address="x"), _record("LONE", {}, address="y", phone="2"),
    ]
    df = _records(spark, *rows)
    decided = resolution.decisions(df)
    entities, held = resolution.merged(df, decided)
    got = {r.record: r.entity for r in entities.collect()}
    assert len(got) == 7 and got["0"] == got["1"] == "0" and got["4"] == got["5"] == "4" and got["6"] == "6"
    assert got["3"] != got["0"] and {(r.kind) for r in held.collect()} == {"uei"}
    values = defaultdict(set)
    for k, (rest, _) in enumerate(rows):
        for kind, v in rest[-1].items():
            values[got[str(k)], kind].add(v)
    assert all(len(v) == 1 for v in values.values())


def _brute(df):
    keys = sorted((r.record, set(r["keys"])) for r in resolution.keyed(df).collect())
    return {(a, b) for i, (a, x) in enumerate(keys) for b, y in keys[i + 1 :] if x & y}


def test_no_key_is_too_wide(spark, monkeypatch):
    """All records that share a key meet, however many; a large block is dealt to cells and loses no pair."""
    rows = [_record(f"GROUP W{k % 7}", {"uei": f"U{k % 3}"} if k % 2 else {}, phone=f"{k % 5}", address=f"{k}") for k in range(230)]
    rows += [_record("GROUP", address="x", phone=None), _record("LONE", address="y", phone=None), _record("BLOCK", address="y", phone=None)]
    df = _records(spark, *rows)
    want = _brute(df)
    assert len(want) > 230 * 229 / 2
    for few, side, most in ((1000, 16, 20_000), (10, 3, 60)):
        monkeypatch.setattr(resolution, "FEW", few)
        monkeypatch.setattr(resolution, "SIDE", side)
        monkeypatch.setattr(resolution, "CELL", most)
        got = [(r.a, r.b) for r in resolution.pairs(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_merging_is_what_decisions_merge(spark):
    """Over 200 records of one identifier: all pairs that merge are found, though only records of one identifier meet."""
    df = _records(spark, *[_record(f"ACME W{k % 3}", {"uei": "U1"} | ({"ein": f"E{k % 2}"} if k % 5 == 0 else {}), phone=f"{k % 4}", address=f"ST {k % 6}") for k in range(210)], _record("ACME W1", {}))
    want = {(r.a, r.b) for r in resolution.decisions(df).filter("decision = 'auto_merge'").collect()}
    assert want == {(r.a, r.b) for r in resolution.merging(df).collect()} and len(want) > 5000
