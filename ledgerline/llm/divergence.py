"""Divergence of sources: how unlike the words of a language's sources are, and which words make a source its own.

1. ``kept_terms``: how many documents of a language hold a term, counted in each
   task before the shuffle; terms of at least ``least`` documents are kept.
2. ``transducers``: one minimal acyclic transducer for each language, made of its
   kept terms as they come sorted (see transducer.py).
3. ``recount``: all texts stream through the transducers; what comes out are
   ordinals, counted by (language, source, ordinal).  Terms that aren't kept end
   where no arc goes on.
4. ``audit``: smoothed shares of each source and of its language in billionths, as
   whole numbers; the sources of a language compared in pairs; the terms that a
   source has more of than its language.  Ties go by ordinal, which is the terms' order.

Transducers go to all workers, so their size is checked: kept terms of up to
``ROOM`` bytes in all (an arc takes at most as many entries as the terms have
bytes, usually a tenth).  Beyond it, terms counted by task, language and source
are joined with the kept terms, and ordinals are row numbers by ranges; same rows.

Pairs of sources are summed in blocks of ``BLOCK`` ordinals by ``TILE`` x ``TILE``
sources, each a small dense matrix.  A term that neither source has adds the same
difference everywhere, so it is added once by their number.

Defined cases: null text, lang and source are empty strings, which are a language
and a source like others; a row counts as a document as often as it stands in
the table; a very long text is read whole; a language without kept terms has pairs
of value 0 and no terms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow_rows import slices
from .scratch import materialise
from .stores import store
from .transducer import Builder, Walker

LEAST = 30
#: Ranks of a source's own terms.
RANKS = 50
#: Bytes of kept terms up to which transducers go to all workers.
ROOM = 8 << 20
#: Counts that a task holds before it passes them on.
HELD = 1 << 20
BLOCK, TILE = 1024, 64
UNIT, SMOOTH = 1_000_000_000, 5
#: The fixed class of characters of a term.
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of terms, A-Z as a-z; 0 stands between terms.  Beyond ASCII, all bytes belong to terms.
_LOW = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 0 for b in range(256)], np.uint8)


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def _counted(docs: DataFrame, by: list[str], once: bool) -> DataFrame:
    """n of each term by the columns ``by``; once: for each document, not for each place.  Summed by task only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[tuple, Counter] = defaultdict(Counter)

        def made() -> pa.RecordBatch:
            keys = [(*k, t, n) for k, terms in total.items() for t, n in terms.items()]
            columns = zip(*keys, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*by, "term", "n"])

        for batch in slices(batches, len(by)):
            groups = zip(*(batch.column(k).to_pylist() for k in range(len(by))), strict=True)
            for key, text in zip(groups, batch.column(len(by)), strict=True):
                found = _TERM.findall(text.as_py().encode().lower().decode())
                total[key].update(set(found) if once else found)
            if sum(map(len, total.values())) > HELD:
                yield made()
                total.clear()
        if any(total.values()):
            yield made()

    schema = ", ".join(f"{c} string" for c in [*by, "term"]) + ", n long"
    return docs.select(*by, "text").mapInArrow(run, schema)


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, term: terms of at least ``least`` documents of the language."""
    counted = _counted(_filled(docs), ["lang"], once=True)
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def transducers(terms: DataFrame) -> DataFrame:
    """terms: lang, term, each once.  Returns lang, made: the bytes of a transducer of all terms of a language.

    A task holds the minimal automaton of a language while its terms pass by; ``ROOM`` bounds all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, current = Builder(), None
        said = lambda: pa.RecordBatch.from_arrays([pa.array([current]), pa.array([builder.finish()], pa.binary())], ["lang", "made"])
        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang != current:
                    if current is not None:
                        yield said()
                    builder, current = Builder(), lang
                builder.add(term.encode())
        if current is not None:
            yield said()

    sorted_ = terms.select("lang", "term").repartition("lang").sortWithinPartitions("lang", "term")
    return sorted_.mapInArrow(run, "lang string, made binary")


def _term_places(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts in a row, where terms start and end, and the text of each."""
    text = text.cast(pa.large_binary())
    at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
    raw = np.frombuffer(text.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    data = _LOW[raw]
    inside = data > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at - at[0]
    edges = first[(first > 0) & (first < len(data))]
    begins[edges] = inside[edges]  # a text's term doesn't go on in the next text
    start = np.flatnonzero(begins)
    stops = np.flatnonzero(~inside)
    end = np.append(stops, len(data))[np.searchsorted(stops, start)]
    row = np.searchsorted(first, start, "right") - 1
    return data, start, np.minimum(end, first[row + 1]), row


class Shared:
    """Transducers by language, sent to all workers, which unpack them once."""

    def __init__(self, spark: SparkSession, made: dict[str, bytes]):
        self.name, self.sent = f"divergence-{uuid.uuid4().hex}", spark.sparkContext.broadcast(made)

    def walker(self) -> Walker:
        return store(self.name, lambda: Walker(self.sent.value))


def recount(docs: DataFrame, shared: Shared) -> DataFrame:
    """lang, source, ordinal, n: how often each kept term stands in the texts of a source; for each source a row with ordinal -1, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = shared.walker()
        groups: dict[tuple[str, str], int] = {}
        wide = max([1, *walker.size.values()])
        keys, sums, held = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            both, n = np.concatenate(keys), np.concatenate(sums)
            found, where = np.unique(both, return_inverse=True)
            return found, np.bincount(where, n, len(found)).astype(np.int64)

        def made_() -> pa.RecordBatch:
            found, n = summed()
            names = list(groups)
            group = pa.array(found // wide, pa.int64())
            columns = [pa.array([x[k] for x in names], pa.string()).take(group) for k in range(2)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(found % wide), pa.array(n)], ["lang", "source", "ordinal", "n"])

        for batch in slices(batches, 2):
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            number = np.array([groups.setdefault(p, len(groups)) for p in pairs], np.int64)
            root = np.array([walker.root.get(p[0], -1) for p in pairs], np.int64)
            data, start, end, row = _term_places(batch.column(2))
            ordinal = walker.ordinals(data, start, end, root[row])
            hit = ordinal >= 0
            found, n = np.unique(number[row[hit]] * wide + ordinal[hit], return_counts=True)
            keys.append(found)
            sums.append(n)
            held += len(found)
            if held > HELD:
                found, n = summed()
                keys, sums, held = [found], [n], len(found)
                if held > HELD // 2:
                    yield made_()
                    keys, sums, held = [], [], 0
        if keys:
            yield made_()
        if groups:
            names = [pa.array([x[k] for x in groups], pa.string()) for k in range(2)]
            none = pa.array(np.full(len(groups), -1)), pa.array(np.zeros(len(groups), np.int64))
            yield pa.RecordBatch.from_arrays([*names, *none], ["lang", "source", "ordinal", "n"])

    counted = _filled(docs).select("lang", "source", "text").mapInArrow(run, "lang string, source string, ordinal long, n long")
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _numbered(terms: DataFrame) -> DataFrame:
    """terms with ordinal, the row number in a language, of whatever size: places in ranges of terms, and the ranges' sums."""
    parts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.spark_partition_id().alias("part")
    ranges = materialise(terms.repartitionByRange(parts, "lang", "term").select("lang", "term", part), "term-ranges")
    sizes = ranges.groupBy("lang", "part").agg(F.count("*").alias("n"))  # a language has at most ``parts`` rows
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("lang", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("term"))
    return ranges.withColumn("nth", place).join(first, ["lang", "part"]).select("lang", "term", (F.col("first") + F.col("nth") - 1).alias("ordinal"))


def counts(docs: DataFrame, least: int = LEAST, room: int = ROOM) -> tuple[DataFrame, DataFrame]:
    """Two tables: lang, term, ordinal; and lang, source, ordinal, n (with ordinal -1 for each source)."""
    terms = materialise(kept_terms(docs, least), "kept-terms")
    size = terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    if size > room:
        terms = materialise(_numbered(terms), "kept-ordinals")
        filled = _filled(docs)
        found = _counted(filled, ["lang", "source"], once=False).join(terms, ["lang", "term"])
        found = found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        none = filled.select("lang", "source", F.lit(-1).cast("long").alias("ordinal"), F.lit(0).cast("long").alias("n")).distinct()
        return terms, materialise(found.unionByName(none), "term-counts")
    # at most ``room`` bytes of terms went in
    made = Shared(docs.sparkSession, {r.lang: bytes(r.made) for r in transducers(terms).collect()})
    found = materialise(recount(docs, made), "term-counts")
    return materialise(_with_ordinals(terms, made), "kept-ordinals"), found


def _with_ordinals(terms: DataFrame, shared: Shared) -> DataFrame:
    """terms with the ordinal that the transducers give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = shared.walker()
        for batch in batches:
            term = batch.column(1).cast(pa.large_binary())
            size = pc.binary_length(term).to_numpy()
            end = np.cumsum(size)
            data = np.frombuffer(b"".join(term.to_pylist()), np.uint8)
            root = np.array([walker.root[x] for x in batch.column(0).to_pylist()], np.int64)
            ordinal = walker.ordinals(data, end - size, end, root)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ordinal)], ["lang", "term", "ordinal"])

    return terms.select("lang", "term").mapInArrow(run, "lang string, term string, ordinal long")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 5) / (total + 5 * kept)), exact: in whole decimals, as the product can exceed 64 bits."""
    above = (n + F.lit(SMOOTH)).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = F.greatest(total + F.lit(SMOOTH) * kept, F.lit(1)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


def _excess(tile: int) -> Callable[[pa.Table], pa.Table]:
    """Of a block of ordinals by some sources: |p - q| summed for pairs of sources, less what terms that neither has would add."""

    def work(table: pa.Table) -> pa.Table:
        names, row = np.unique(table.column("number").to_numpy(), return_inverse=True)
        base = np.zeros(len(names), np.int64)
        base[row] = table.column("p0").to_numpy()
        ordinal = table.column("ordinal").to_numpy()
        said = ordinal >= 0
        terms, column = np.unique(ordinal[said], return_inverse=True)
        p = np.repeat(base[:, None], len(terms), axis=1)
        p[row[said], column] = table.column("p").to_numpy()[said]
        one, other = table.column("one")[0].as_py(), table.column("other")[0].as_py()
        a, b, value = [], [], []
        for i in np.flatnonzero(names // tile == one).tolist():
            theirs = np.flatnonzero((names // tile == other) & (names > names[i]))
            a.append(np.full(len(theirs), names[i]))
            b.append(names[theirs])
            value.append(np.abs(p[i] - p[theirs]).sum(axis=1) - p.shape[1] * np.abs(base[i] - base[theirs]))
        lang = pa.array([table.column("lang")[0].as_py()] * sum(map(len, a)), pa.string())
        numbers = (pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a, b, value))
        return pa.table([lang, *numbers], ["lang", "a", "b", "excess"])

    return work


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS, room: int = ROOM) -> DataFrame:
    """lang, source, part, item, value, rank.

    part ``pair``: the other sources of the language by their distance; ``term``: the terms that the source has most more of.
    """
    terms, found = counts(docs, least, room)
    size = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    groups = found.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(size, "lang", "left").na.fill(0, ["kept"])
    zero = F.lit(0).cast("long")
    order = Window.partitionBy("lang").orderBy("source")  # a row for each source of a language
    groups = groups.withColumns({"number": F.row_number().over(order).cast("long") - 1, "p0": _share(zero, F.col("total"), F.col("kept"))})
    groups = materialise(groups, "sources")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("kept").alias("kept"), F.count("*").alias("sources"))
    shares = found.filter("ordinal >= 0").join(groups, ["lang", "source"])
    shares = shares.withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))

    # terms
    whole = found.filter("ordinal >= 0").groupBy("lang", "ordinal").agg(F.sum("n").alias("of_lang"))
    whole = whole.join(langs.select("lang", "all", F.col("kept").alias("v")), "lang")
    whole = whole.select("lang", "ordinal", _share(F.col("of_lang"), F.col("all"), F.col("v")).alias("q"))
    more = shares.join(whole, ["lang", "ordinal"]).filter("n > 0 AND p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = more.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= ranks)
    top = top.join(terms, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # pairs: a row goes to each tile that its source is compared in
    own = F.floor(F.col("number") / TILE)
    placed = shares.select("lang", "number", "ordinal", "p", "p0", F.floor(F.col("ordinal") / BLOCK).alias("block"))
    # a source without a term of a block is compared in it all the same
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / BLOCK)))
    there = groups.filter("kept > 0").select("lang", "number", F.lit(-1).cast("long").alias("ordinal"), F.col("p0").alias("p"), "p0", each.alias("block"))
    placed = placed.unionByName(there).join(langs.select("lang", "sources"), "lang")
    placed = placed.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("sources") - 1) / TILE))))
    blocks = placed.select(
        "lang",
        F.least(own, "tile").alias("one"),
        F.greatest(own, "tile").alias("other"),
        "block",
        "number",
        "ordinal",
        "p",
        "p0",
    )
    excess = blocks.groupBy("lang", "one", "other", "block").applyInArrow(_excess(TILE), "lang string, a long, b long, excess long")
    excess = excess.groupBy("lang", "a", "b").agg(F.sum("excess").alias("excess"))
    g = groups.select("lang", "source", "number", "p0", "kept")
    h = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("number2"), F.col("p0").alias("p02"))
    pair = g.join(h, "lang").filter("number <> number2")  # the pairs are the result
    pair = pair.withColumns({"a": F.least("number", "number2"), "b": F.greatest("number", "number2")}).join(excess, ["lang", "a", "b"], "left")
    value = F.when(F.col("kept") > 0, F.col("kept") * F.abs(F.col("p0") - F.col("p02")) + F.coalesce("excess", F.lit(0))).otherwise(F.lit(0))
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pair.withColumn("rank", F.row_number().over(far)).unionByName(top)
