"""Spelling variants: words of the corpus one edit apart, and the common form of each.

Blocks.  Two words one edit apart, the shorter of ``size`` letters, agree on
the first half of the shorter one or on its last half, since the edit lies
in only one of both.  So each word goes to a block for each half, once with the
words of its own size and one letter more, once with those of one letter less and
its own size.  A block of more than ``LIMIT`` words is split in the same way at the
half of what is left between the parts that agree, until it is small; a window of
one letter ends that, where a block has at most 90 + 90 * 90 words, fewer than
``LIMIT``.  A pair counts in the block whose window holds the place where its
words first differ, so it is found once.

Scan.  The words of a block are sorted, and each of them goes down the list behind
it with rows of the edit matrix, one for each letter of the listed word, of which
only the band of three cells around the diagonal can stay at one edit.  Rows of the
prefix that a word shares with the one before it (their LCP) are kept; where all
cells of a row exceed one edit, the scan skips to the first word that doesn't
share that prefix.  All words of many blocks take their steps together, as arrays.

Result.  Pairs are never rows: a block gives for each of its words how many near
words it has there, and the most frequent of them.  Forms are followed to their
ends by pointer jumping; counts grow tenfold at each, so that takes a few rounds.

Defined cases: null and empty texts have no words; a row counts as often as it
stands in the table, under its own doc_id; a null doc_id is written as nothing;
very long texts are read whole, one at a time; words of equal count are taken in
code-point order; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import slices
from .scratch import materialise, release

SHORTEST = 7
#: A block of more words than this is split; above 90 + 90 * 90, what a window of one letter can hold.
LIMIT = 10_000
#: A block whose windows have more letters than this is split, too.
LETTERS = 1 << 20
#: Letters of words, with room for the longest, that take their steps together.
TOGETHER = 1 << 22
#: Distinct words that a task counts before it passes them on.
ROOM = 1 << 20
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")


def words(docs: DataFrame, damaged: int = 31) -> DataFrame:
    """word, n: how often each word of at least ``SHORTEST`` letters stands in the texts.

    Of one in ``damaged`` words of a document, by the checksum of both, a letter is missing.
    """
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema.fieldNames())

        for batch in slices(batches, 1):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                found = Counter(_RUN.findall(text.encode().lower().decode()))
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % damaged == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < SHORTEST:
                            continue
                    total[word] += n
            if len(total) > ROOM:
                yield made()
                total.clear()
        if total:
            yield made()

    found = docs.select(F.col("doc_id").cast("string"), F.col("text")).mapInArrow(counted, schema)
    return found.groupBy("word").agg(F.sum("n").alias("n"))


# ---- scan of one list


def _next_row(row: tuple[int, int, int], same: int) -> tuple[int, int, int]:
    """The band of the next row of the edit matrix; 2 stands for all above 1.  Bits of ``same``: which cells' letters agree."""
    low = min(row[0] + (not same & 1), row[1] + 1, 2)
    mid = min(row[1] + (not same & 2), row[2] + 1, low + 1, 2)
    return low, mid, min(row[2] + (not same & 4), mid + 1, 2)


_ROWS = [(a, b, c) for a in range(3) for b in range(3) for c in range(3)]
_NUMBER = {r: k for k, r in enumerate(_ROWS)}
#: number of a row * 8 + which letters agree -> number of the next row
_NEXT = np.array([_NUMBER[_next_row(r, e)] for r in _ROWS for e in range(8)], np.uint8)
_DEAD = np.array([min(r) > 1 for r in _ROWS])
#: [length of the word scanned for - length of the listed word + 1, row]: whether the cell at both ends is exactly one edit
_NEAR = np.array([[r[k] == 1 for r in _ROWS] for k in range(3)])
_SELF = _NUMBER[(1, 0, 1)]


def near_pairs(letters: np.ndarray, length: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of sorted lists, one after the other: rows of pairs one edit apart (the earlier, the later), and where they first differ.

    letters: a row of codes for each word, with at least two zeros behind it; length: their numbers; end: where the list
    of each row ends.
    """
    rows, width = letters.shape
    before = np.zeros((rows, width), bool)  # before[i, d]: word i shares its first d letters with word i - 1 of the list
    before[1:, 0] = end[1:] == end[:-1]
    agree = (letters[1:] == letters[:-1]) & (np.arange(width) < np.minimum(length[1:], length[:-1])[:, None])
    before[1:, 1:] = np.logical_and.accumulate(agree, axis=1)[:, :-1] & before[1:, :1]
    lcp = before.sum(axis=1) - 1
    # skip[d, i]: the first row behind i that doesn't share the first d letters of row i
    skip = np.empty((width, rows), np.int32)
    for d in range(width):
        breaks = np.append(np.flatnonzero(~before[:, d]), rows)
        skip[d] = breaks[np.searchsorted(breaks, np.arange(rows), "right")]
    at = np.arange(rows)
    q = at[at + 1 < end]
    stack = np.full((len(q), width), _SELF, np.uint8)
    stack[:, 0] = _NUMBER[(2, 0, 1)]
    slot, j = np.arange(len(q)), q + 1
    depth = lcp[j].copy()
    split = depth.copy()  # how many first letters of q the listed word shares
    flat, band = letters.reshape(-1), stack.reshape(-1)
    while len(q):
        c = flat[j * width + depth]
        own = q * width + depth
        # the first column has no letter in front of it; its row says 2, so that any letter does
        same = (flat[own - (depth > 0)] == c) | (flat[own] == c) * np.uint8(2) | (flat[own + 1] == c) * np.uint8(4)
        same &= np.where(depth > 0, np.uint8(7), np.uint8(6))
        row = _NEXT[band[slot * width + depth] * np.int64(8) + same]
        ended = length[j] == depth
        row = np.where(ended, band[slot * width + depth], row)
        band[slot * width + depth + ~ended] = row
        depth += ~ended
        more = length[q] - length[j] + 1
        hit = (length[j] == depth) & (more >= 0) & (more <= 2)
        hit[hit] = _NEAR[more[hit], row[hit]]
        if hit.any():
            yield q[hit], j[hit], split[hit]
        dead = _DEAD[row]
        done = dead | (length[j] == depth)
        moved = np.where(dead, skip[depth, j], j + 1)
        j = np.where(done, moved, j)
        here = j < end[q]
        if not here.all():
            q, slot, j, depth, split, done = q[here], slot[here], j[here], depth[here], split[here], done[here]
        # a row of the prefix that the next word shares with the last one stays
        back = lcp[j[done]]
        depth[done] = np.minimum(back, depth[done])
        split[done] = np.minimum(back, split[done])


# ---- blocks


def _blocks(rows: DataFrame) -> DataFrame:
    """rows (word, n, size, head, tail): the same with block, the key of those that share size, head and tail."""
    key = F.concat_ws(
        "/",
        F.col("size").cast("string"),
        F.col("head").cast("string"),
        F.col("tail").cast("string"),
        F.expr("left(word, head)"),
        F.expr("right(word, tail)"),
    )
    return rows.withColumn("block", key)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of the window in the head, and with the last half in the tail."""
    half = "(size - head - tail) div 2"
    ways = F.expr(f"array(struct(head + {half} AS head, tail AS tail), struct(head AS head, size - head - {half} AS tail))")
    return rows.withColumn("way", F.explode(ways)).select("word", "n", "size", "way.head", "way.tail")


def blocked(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n, size, head, tail, block: every pair one edit apart meets in the block whose window holds its edit."""
    sizes = F.expr(f"filter(array(length(word), length(word) - 1), s -> s >= {SHORTEST})")
    whole = found.withColumn("size", F.explode(sizes)).select("word", "n", "size", F.lit(0).alias("head"), F.lit(0).alias("tail"))
    rows = materialise(_blocks(_halved(whole)), "spelling")
    kept = None
    while True:
        window = F.col("size") - F.col("head") - F.col("tail")
        sums = rows.groupBy("block").agg(
            F.count("*").alias("many"),
            F.min(F.expr("length(word) - size")).alias("longer"),
            F.min(window).alias("window"),
            F.sum(window + 1).alias("letters"),
        )
        # a block of the longer words alone has no pair of its own
        sums = sums.filter("longer = 0 AND many > 1").withColumn(
            "large", ((F.col("many") > limit) | (F.col("letters") > LETTERS)) & (F.col("window") > 1)
        )
        sums = materialise(sums.select("block", "large"), "spelling-blocks")
        small = rows.join(sums.filter("NOT large"), "block", "left_semi")
        kept = small if kept is None else kept.unionByName(small)
        large = sums.filter("large")
        if large.isEmpty():
            return kept
        rows = materialise(_blocks(_halved(rows.join(large, "block", "left_semi").drop("block"))), "spelling")


_FOUND = "word string, n_near long, form string, form_n long"


def _scanned(words_: list[bytes], n: np.ndarray, block: np.ndarray, size: np.ndarray, head: np.ndarray, tail: np.ndarray) -> pa.RecordBatch:
    """For each word of some whole blocks, one after the other: its near words there, counted, and the most frequent one."""
    length = np.fromiter(map(len, words_), np.int64, len(words_)) - head - tail
    width = int(length.max()) + 3
    pool = np.frombuffer(b"".join(words_) + bytes(width), np.uint8)
    start = np.cumsum(length + head + tail) - length - tail
    at = np.arange(width)
    letters = np.where(at < length[:, None], pool[np.minimum(start[:, None] + at, len(pool) - 1)], np.uint8(0))
    last = np.flatnonzero(np.append(block[1:] != block[:-1], True))
    end = last[np.searchsorted(last, np.arange(len(block)))] + 1
    first = np.concatenate(([0], last[:-1] + 1))[np.searchsorted(last, np.arange(len(block)))]
    window = size - head - tail
    count = np.zeros(len(words_), np.int64)
    best = np.full(len(words_), -1, np.int64)
    # of the words of a block, the one of largest n, then the first in order, has the smallest rank
    rank = np.empty(len(words_), np.int64)
    rank[np.lexsort((np.arange(len(n)), -n, first))] = np.arange(len(n))
    least = np.full(len(words_), len(n), np.int64)
    for a, b, split in near_pairs(letters, length, end):
        # both of the longer size: a pair of another block; a place behind the window is the tail's, unless that is empty
        mine = (np.minimum(length[a], length[b]) == window[a]) & ((split < window[a]) | (tail[a] == 0))
        a, b = a[mine], b[mine]
        for x, y in ((a, b), (b, a)):
            np.add.at(count, x, 1)
            np.minimum.at(least, x, rank[y])
    of_rank = np.argsort(rank)
    hit = np.flatnonzero(count)
    best = of_rank[least[hit]]
    said = [w.decode("latin-1") for w in words_]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([said[i] for i in hit.tolist()], pa.string()),
            pa.array(count[hit]),
            pa.array([said[i] for i in best.tolist()], pa.string()),
            pa.array(n[best], pa.int64()),
        ],
        ["word", "n_near", "form", "form_n"],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole blocks, sorted, in parts of about ``TOGETHER`` letters."""
    held: list[tuple] = []
    number, current, widest = 0, None, 0

    def made() -> pa.RecordBatch:
        said, n, block, size, head, tail = zip(*held, strict=True)
        return _scanned(list(said), *(np.array(x, np.int64) for x in (n, block, size, head, tail)))

    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in range(batch.num_columns))
        for block, word, n, size, head, tail in zip(*columns, strict=True):
            if block != current:
                number, current = number + 1, block
                wider = max(widest, size - head - tail + 4)
                if held and len(held) * wider > TOGETHER:
                    yield made()
                    held, wider = [], size - head - tail + 4
                widest = wider
            held.append((word.encode("latin-1"), n, number, size, head, tail))
    if held:
        yield made()


def near(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """found: word, n.  Returns word, n_near, form, form_n (the most frequent near word) for words that have near words."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = blocked(found, limit).select("block", "word", "n", "size", "head", "tail")
    lists = rows.repartition(parts, "block").sortWithinPartitions("block", "word")
    partial = lists.mapInArrow(_scan, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return (
        partial.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    )


def _ends(forms: DataFrame) -> DataFrame:
    """forms: word, root (the next word).  Returns word, root with root the last word of the chain."""
    forms = materialise(forms, "spelling-roots")
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("end"))
        step = forms.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("went"))
        step = materialise(step, "spelling-roots")
        release(forms)
        forms = step.drop("went")
        if step.filter("went").isEmpty():
            return forms


def variants(docs: DataFrame, least: int = 2, times: int = 10, damaged: int = 31, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word that stands at least ``least`` times in the texts.

    form: the most frequent word one edit away, if it stands at least ``times`` as often; root: where forms end.
    """
    found = materialise(words(docs, damaged).filter(F.col("n") >= least), "spelling-words")
    close = found.join(near(found, limit), "word", "left")
    common = F.col("form_n") >= times * F.col("n")
    close = close.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("form")).alias("form"),
        F.when(common, F.col("form_n")).alias("form_n"),
    )
    close = materialise(close, "spelling-forms")
    roots = _ends(close.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return close.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
