"""Operators 11 to 13 against plain versions, and on awkward rows."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import brute
import cases
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import divergence, online_packing, queries, spelling
from ledgerline.llm.transducer import ARC, Builder, Walker

SMALL = "/root/testdata/sf0.001"
WORDS = P.path("word_bpe_49k.json")


# ---- transducers


def _strings(seed, n):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcé的") for _ in range(rng.randrange(1, 9))).encode() for _ in range(n)})


def _walk(walker, key, strings):
    end = np.cumsum([len(s) for s in strings])
    data = np.frombuffer(b"".join(strings), np.uint8)
    return walker.ordinals(data, end - [len(s) for s in strings], end, np.full(len(strings), walker.root.get(key, -1))).tolist()


def test_ordinals_are_the_sorted_places():
    made, lists = {}, {"x": _strings(1, 3000), "y": _strings(2, 500), "one": [b"a"]}
    for key, strings in lists.items():
        b = Builder()
        for s in strings:
            b.add(s)
        made[key] = b.finish()
    made["none"] = Builder().finish()
    w = Walker(made)
    for key, strings in lists.items():
        assert _walk(w, key, strings) == list(range(len(strings))) and w.size[key] == len(strings)
        others = [s + b"a" for s in strings[:300]] + [s[:-1] or b"q" for s in strings[:300]]
        place = {s: i for i, s in enumerate(strings)}
        assert _walk(w, key, others) == [place.get(s, -1) for s in others]
    assert _walk(w, "none", [b"a"]) == [-1] == _walk(w, "unknown", [b"a"])


def test_automata_are_minimal():
    strings = _strings(3, 800)
    b = Builder()
    for s in strings:
        b.add(s)
    blob = b.finish()
    n_arcs, n_states, _ = np.frombuffer(blob, "<i8", 3).tolist()
    # as many states as there are different sets of ways to go on
    rest = defaultdict(set)
    for s in strings:
        for k in range(len(s) + 1):
            rest[s[:k]].add(s[k:])
    assert n_states == len({frozenset(x) for x in rest.values()})
    assert n_arcs == sum(len({x[0] for x in r if x}) for r in {frozenset(x) for x in rest.values()}) and ARC.itemsize == 13
    with pytest.raises(ValueError, match="ascend"):
        b = Builder()
        b.add(b"b")
        b.add(b"a")


# ---- divergence of sources


def _divergence(rows, least, ranks):
    """lang, source, part, item, value, rank."""
    docs = [(lang or "", source or "", divergence._TERM.findall(brute.lower(text or ""))) for lang, source, text in rows]
    df = Counter((lang, t) for lang, _, terms in docs for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= least:
            kept[lang].append(t)
    count = Counter((lang, source, t) for lang, source, terms in docs for t in terms if df[lang, t] >= least)
    groups = sorted({(lang, source) for lang, source, _ in docs})
    share = {}
    for lang, source in groups:
        n, v = sum(count[lang, source, t] for t in kept[lang]), len(kept[lang])
        share[lang, source] = {t: 1 + 10**9 * (count[lang, source, t] + 5) // (n + 5 * v) for t in kept[lang]}
    out = set()
    for lang, source in groups:
        own, p = [s for x, s in groups if x == lang], share[lang, source]
        whole = {t: sum(count[lang, s, t] for s in own) for t in kept[lang]}
        total = sum(whole.values()) + 5 * len(kept[lang])
        q = {t: 1 + 10**9 * (whole[t] + 5) // total for t in kept[lang]}
        pair = sorted((-sum(abs(p[t] - share[lang, s][t]) for t in p), s.encode()) for s in own if s != source)
        term = sorted((q[t] - p[t], t.encode()) for t in p if count[lang, source, t] and p[t] > q[t])[:ranks]
        for part, found in (("pair", pair), ("term", term)):
            out |= {(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(found, 1)}
    return out


def _texts(seed, n, sources=7):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉé的") for _ in range(rng.randrange(1, 4))) for _ in range(80)]
    lang = lambda: rng.choice(["en", "en", "de", None, ""])
    return [(i, " 7,".join(rng.choice(words) for _ in range(rng.randrange(30))), lang(), f"s{rng.randrange(sources)}") for i in range(n)]


def _sourced(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", "y", "z") for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n string, ordinal string, p0 string")


@pytest.mark.parametrize("room", [divergence.ROOM, 0])
def test_divergence_brute(spark, monkeypatch, room):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "BLOCK", 16)
    monkeypatch.setattr(divergence, "HELD", 500)
    rows = [*_texts(4, 400), (1, None, "en", None), (1, None, "en", None), (2, "", "xx", "alone"), (3, "solo", "yy", "a"), (3, "solo", "yy", "b")]
    got = divergence.audit(_sourced(spark, rows), least=8, ranks=5, room=room).collect()
    want = _divergence([(lang, s, t) for _, t, lang, s in rows], 8, 5)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert ("yy", "a", "pair", "b", 0, 1) in want and not any(r[0] == "yy" and r[2] == "term" for r in want)


def test_divergence_awkward_rows(spark):
    got = divergence.audit(cases.docs(spark), least=1).collect()
    want = _divergence([(r.lang, r.source, r.text) for r in cases.docs(spark).collect()], 1, 50)
    assert {tuple(r) for r in got} == want
    assert divergence.audit(cases.docs(spark, [])).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    n = 9 * 10**17
    df = spark.createDataFrame([(n, n + 7, 3)], "n long, total long, kept long")
    from pyspark.sql import functions as F

    assert df.select(divergence._share(F.col("n"), F.col("total"), F.col("kept"))).first()[0] == 1 + 10**9 * (n + 5) // (n + 7 + 15)


def test_op11_brute(spark):
    rows = [(r.lang, r.source, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = queries.op11_source_divergence(spark, SMALL).collect()
    assert {tuple(r) for r in got} == _divergence(rows, 30, 50)


# ---- online packing


def _sequences(rows, capacity=2048):
    """Checks the places of all pieces; sequence -> length."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return {s: sum(n for _, n in p) for s, p in bins.items()}


def _padding(lengths, capacity=2048):
    return sum(capacity - n for n in lengths if n & (n - 1))


def _pieces_are_the_documents(rows, texts, end=1):
    t, by = Tokenizer.from_file(WORDS), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for i, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [end]
        at = 0
        for r in sorted(by.pop(i), key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            if getattr(r, "ids", None) is not None:
                assert bytes(r.ids) == struct.pack(f"<{len(part)}I", *part)
            at += r.length
        assert at == len(ids)
    assert not by


def test_op12_brute(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op12_online_packing(spark, SMALL).collect()
    _pieces_are_the_documents(rows, texts)
    lengths = _sequences(rows)
    assert _padding(lengths.values()) == 0
    # as few sequences as the tokens need, but for the last one's parts
    assert len(lengths) <= sum(lengths.values()) // 2048 + 11


def test_packing_many_partitions(spark):
    rng = random.Random(9)
    texts = {i: " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(rng.choice([1, 40, 300, 900, 5000]))) for i in range(300)}
    docs = cases.docs(spark, list(texts.items())).repartition(7)
    for least in (1, 64):
        rows = online_packing.pack(docs, WORDS, most=4, least=least).collect()
        _pieces_are_the_documents(rows, texts)
        lengths = _sequences(rows)
        cuts = len(rows) - sum(-(-(len(t.split()) + 1) // 2048) for t in texts.values())
        if least == 1:
            assert _padding(lengths.values()) == 0
        else:
            assert 0 < _padding(lengths.values()) < 64 * len(lengths)
        assert cuts < len(texts)


def test_windows_keep_their_rules():
    rng = random.Random(4)
    w, fill, emitted = online_packing.Windows(0, 100, 3), Counter(), []
    for _ in range(500):
        total, before = rng.randrange(1, 250), list(w.open)
        pieces = w.place(total)
        assert len(w.open) == 3 and w.open == sorted(w.open)
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces])[:-1]) and sum(p[1] for p in pieces) == total
        rest = total % 100
        fits = [room for room, _ in before if room >= rest]
        if rest and fits:  # the window that has least room left takes it
            assert 100 - pieces[-1][3] == min(fits)
        elif rest:  # the fullest is filled up and goes
            assert 100 - next(p for p in pieces if p[1] < 100)[3] == before[0][0] and before[0][1] in w.emitted
        for _, n, s, at in pieces:
            assert fill[s] == at
            fill[s] += n
        emitted += w.emitted
        w.emitted.clear()
    assert all(fill[s] == 100 for s in emitted) and len(set(emitted)) == len(emitted)


def test_online_packing_awkward_rows(spark):
    rows = online_packing.pack(cases.docs(spark), WORDS).collect()
    t = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, text in cases.TEXTS:
        want[i] += len(t.encode(text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == want and _padding(_sequences(rows).values()) == 0
    _pieces_are_the_documents([r for r in rows if r.doc_id != 5], {i: x for i, x in cases.TEXTS if i != 5})
    assert online_packing.pack(cases.docs(spark, []), WORDS).count() == 0


# ---- spelling variants


def _variants(docs, damaged=31, least=2):
    import re

    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= least}
    around = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            around[w[:k] + w[k + 1 :]].add(w)
    out = {}
    for w in n:
        near = set()
        for k in range(len(w)):
            less = w[:k] + w[k + 1 :]
            near |= {less} & n.keys()  # w has one more
            # the same letter gone at the same place: one replaced
            near |= {x for x in around[less] if x != w and len(x) == len(w) and any(x[:j] + x[j + 1 :] == w[:j] + w[j + 1 :] for j in range(len(w)))}
        near |= around[w]  # one less
        best = min(near, key=lambda x: (-n[x], x), default=None)
        out[w] = [best if best and n[best] >= 10 * n[w] else None, len(near)]
    found = {}
    for w, (form, many) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        found[w] = (form, root, n[w], many, n[form] if form else None)
    return found


def _plain(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_op13_brute(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = _variants(docs)
    assert _plain(queries.op13_spelling_variants(spark, SMALL).collect()) == want
    assert any(x[0] for x in want.values()) and max(x[3] for x in want.values()) > 2


@pytest.mark.parametrize("limit", [spelling.LIMIT, 5])
def test_variants_of_crowded_words(spark, limit):
    """Few letters, so that most words have near ones and blocks are large: also where they have to be split."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 12))) for _ in range(500)]
    # chains of forms: each ten times as often as the one before
    chain = ["letterss", "letters", "lettets", "lettetz"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(100)]
    whole = [next(i for i in range(1000 * k, 9999) if zlib.crc32(f"{i}:{w}".encode()) % 5) for k, w in enumerate(chain, 1)]
    rows += [(i, " ".join([w] * (2 * 11**k))) for k, (i, w) in enumerate(zip(whole, chain, strict=True))]
    rows += [(i, x) for i, x in cases.TEXTS] + [(77, "ab" * 3000 + " " + "ab" * 2999 + "a " + "ab" * 3000 + " " + "ab" * 2999 + "a")]
    docs = cases.docs(spark, rows).repartition(3)
    got = _plain(spelling.variants(docs, damaged=5, limit=limit).collect())
    want = _variants([(i, t) for i, t in rows], damaged=5)
    assert got == want
    assert any(x[1] not in (w, x[0]) for w, x in want.items())  # a chain of two forms at least


def test_variants_awkward_rows(spark):
    got = _plain(spelling.variants(cases.docs(spark)).collect())
    assert got == _variants(cases.TEXTS)
    assert spelling.variants(cases.docs(spark, [])).count() == 0


def test_blocks_meet_every_pair_once(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(400)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    for limit in (1000, 12):
        sizes = [r["count"] for r in spelling.blocked(df, limit).groupBy("block").count().collect()]
        assert max(sizes) <= max(limit, 2 + 4)
        got = {r.word: r.n_near for r in spelling.near(df, limit).collect()}
        edits = lambda w: {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in ("a", "b", "")} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in "ab"}
        want = {w: len((edits(w) - {w}) & set(words)) for w in words}
        assert got == {w: n for w, n in want.items() if n}


def test_lists_are_scanned_as_arrays():
    words = [b"", b"a", b"ab", b"abc", b"b", b"bc"]
    letters = np.zeros((6, 6), np.uint8)
    for i, w in enumerate(words):
        letters[i, : len(w)] = list(w)
    length = np.array([len(w) for w in words])
    pairs = {(int(a), int(b), int(s)) for x in spelling.near_pairs(letters, length, np.full(6, 6)) for a, b, s in zip(*x, strict=True)}
    assert pairs == {(0, 1, 0), (0, 4, 0), (1, 2, 1), (1, 4, 0), (2, 3, 2), (2, 4, 0), (3, 5, 0), (4, 5, 1)}
