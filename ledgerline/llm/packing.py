"""Packing of token pieces into sequences by a swap-based local search.

Only lengths matter to a packing, and there are at most ``capacity`` of them,
so the search works on the histogram of lengths: a bin is a pattern (how many
pieces of which length) with a multiplicity, and one step changes all bins of
a pattern alike.  It starts from the plainest packing, every piece in a bin of
its own, and takes bins from the fullest: between it and a bin that is no
fuller it makes the move, or the exchange of one for one, two for one or one for
two, that leaves least room in the fuller of both.  Each step increases the
sum of squared fills, so full bins get fuller until others are empty; it ends
when the number of bins is what the tokens need, or no step helps.

``plan`` works through a large histogram in levels: a level packs the counts
divided by a power-like unit, at most about ``PIECES`` of them, keeps the full
bins times the unit and leaves the rest to the next level with a smaller unit; the
last has unit 1.  So the driver's work grows with the logarithm of the number of
documents.  The resulting table of segments is bounded by capacity and levels.

``pack`` numbers the pieces of each length - counts by (length, shard), sums
of the counts, then places within a (length, shard) - and looks the number up
in the segments.

Defined cases: null or empty text is the end token alone; texts longer than
a sequence are cut, all others stay whole; very long texts are encoded one at a
time; rows that repeat are packed each; pieces of equal length and id take their
places in any order; null doc_id is an id like another; an empty table gives no
rows; other columns of pieces, whatever their names, are carried along, those
with names of the result are replaced.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import add_columns, fresh, slices
from .scratch import materialise
from .tokens import WordIds, coder

CAPACITY = 2048
#: Pieces that one level of the search looks at, about.
PIECES = 100_000
#: Bytes of text that a worker cuts into words at a time: what it builds beside them is some ten times that.
SLICE = 1 << 20
Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit): a row for each piece."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches):
        own = coder(WordIds, tokenizer_path)
        for batch in slices(batches, 1, SLICE):
            row, piece, ids = [], [], []
            found, at = own.ids(batch.column(1))
            for i in range(len(batch)):
                all_ids = found[at[i] : at[i + 1]].tobytes() + end
                for n, cut in enumerate(range(0, len(all_ids), step)):
                    row.append(i)
                    piece.append(n)
                    ids.append(all_ids[cut : cut + step])
            piece_ = pa.array(piece, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    piece_,
                    pa.array(np.array(piece, np.int64) * capacity),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                schema.fieldNames(),
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _fill(p: Pattern) -> int:
    return sum(s * n for s, n in p)


def _pairs(p: Pattern) -> list[int]:
    """The sums of two pieces of a bin."""
    return sorted({x + y for i, (x, n) in enumerate(p) for y, _ in p[i + (n < 2) :]})


def _two_of(p: Pattern, total: int) -> list[int]:
    have = dict(p)
    return next([x, total - x] for x in have if total - x in have and (2 * x != total or have[x] > 1))


def _changed(p: Pattern, out: list[int], into: list[int]) -> Pattern:
    c = Counter(dict(p))
    c.subtract(out)
    c.update(into)
    return tuple(sorted(((s, n) for s, n in c.items() if n), reverse=True))


class _Table:
    """Rows of integers that grow: slot, what a bin of it could give, its room (-1: the slot is gone)."""

    def __init__(self):
        self.all, self.n = np.empty((1024, 3), np.int64), 0

    @property
    def rows(self) -> np.ndarray:
        return self.all[: self.n]

    def add(self, slot: int, gives: list[int], room: int) -> None:
        end = self.n + len(gives)
        while end > len(self.all):
            self.all = np.concatenate((self.all, np.empty_like(self.all)))
        self.all[self.n : end, 0], self.all[self.n : end, 1], self.all[self.n : end, 2] = slot, gives, room
        self.n = end

    def drop(self, slot: int) -> None:
        low, high = np.searchsorted(self.rows[:, 0], [slot, slot + 1])
        self.all[low:high, 2] = -1

    def squeeze(self) -> None:
        kept = self.rows[self.rows[:, 2] >= 0]
        self.all[: len(kept)], self.n = kept, len(kept)


class _Bins:
    """The underfull bins of a search, a slot for each pattern."""

    def __init__(self, bins: Counter, capacity: int):
        self.capacity, self.full = capacity, Counter()
        self.pattern: list[Pattern] = []
        self.times: list[int] = []
        self.slot: dict[Pattern, int] = {}
        self.room: list[int] = []
        self.waiting: list[tuple[int, int]] = []  # heap: room, slot
        # giving nothing, one piece, two pieces
        self.give = (_Table(), _Table(), _Table())
        for p, n in sorted(bins.items()):
            self.add(p, n)

    def add(self, p: Pattern, n: int) -> None:
        room = self.capacity - _fill(p)
        if not p or not room:
            self.full[p] += n
            return
        k = self.slot.get(p)
        if k is None:
            k = self.slot[p] = len(self.pattern)
            self.pattern.append(p)
            self.times.append(0)
            self.room.append(room)
            for table, sums in zip(self.give, ([0], [s for s, _ in p], _pairs(p)), strict=True):
                table.add(k, sums, room)
        self.times[k] += n
        heapq.heappush(self.waiting, (room, k))

    def take(self, k: int, n: int) -> None:
        self.times[k] -= n
        if not self.times[k]:
            del self.slot[self.pattern[k]]
            for table in self.give:
                table.drop(k)

    def _best(self, mine: int, theirs: int, k: int, takes: bool) -> tuple | None:
        """(room left, taker, giver, what the taker gives, what it gets) of the best step between k and another slot.

        mine, theirs: how many pieces either gives; takes: k is the fuller of both.
        """
        own, rows = self.give[mine].rows, self.give[theirs].rows
        own = own[slice(*np.searchsorted(own[:, 0], [k, k + 1])), 1]
        room = self.room[k]
        fits = rows[:, 2] >= room if takes else (rows[:, 2] >= 0) & (rows[:, 2] <= room)
        if self.times[k] < 2:
            fits &= rows[:, 0] != k
        rows = rows[fits]
        if not len(rows) or not len(own):
            return None
        net = (rows[None, :, 1] - own[:, None]) * (1 if takes else -1)
        left = (room if takes else rows[None, :, 2]) - net
        left = np.where((net > 0) & (left >= 0), left, self.capacity)
        i, j = divmod(int(np.argmin(left)), len(rows))
        if left[i, j] == self.capacity:
            return None
        other, mine_, theirs_ = int(rows[j, 0]), int(own[i]), int(rows[j, 1])
        return int(left[i, j]), *((k, other, mine_, theirs_) if takes else (other, k, theirs_, mine_)), mine, theirs, takes

    def step(self, k: int) -> tuple[str, int] | None:
        """Makes the best step that k has a part in: its kind, and how many bins it emptied; None if there is none."""
        best = None
        if not self.times[k]:
            return None
        for taker, giver in STEPS:
            for takes in (True, False):
                found = self._best(taker if takes else giver, giver if takes else taker, k, takes)
                if found and (best is None or found[0] < best[0]):
                    best = found
                if best and not best[0]:
                    break
            if best and not best[0]:
                break
        if not best:
            return None
        _, a, b, out, into, mine, theirs, takes = best
        kind = (mine, theirs) if takes else (theirs, mine)
        pa, pb = self.pattern[a], self.pattern[b]
        pieces = lambda p, many, total: ([], [total], [])[many] if many < 2 else _two_of(p, total)
        gone, come = pieces(pa, kind[0], out), pieces(pb, kind[1], into)
        times = self.times[a] // 2 if a == b else min(self.times[a], self.times[b])
        self.take(a, times)
        self.take(b, times)
        emptied = 0
        for p in (_changed(pa, gone, come), _changed(pb, come, gone)):
            if p:
                self.add(p, times)
            else:
                emptied += times
        if self.times[k]:
            heapq.heappush(self.waiting, (self.room[k], k))
        return STEPS[kind], emptied


#: (pieces that the fuller bin gives, pieces that it gets) -> name
STEPS = {(0, 1): "move", (1, 1): "one for one", (1, 2): "two for one", (2, 1): "one for two"}


def local_search(bins: Counter, capacity: int) -> tuple[Counter, Counter]:
    """Better bins, and how often each kind of step was made."""
    need = -(-sum(_fill(p) * n for p, n in bins.items()) // capacity)
    count, made = bins.total(), Counter()
    work = _Bins(bins, capacity)
    while count > need and work.waiting:
        done = work.step(heapq.heappop(work.waiting)[1])
        if done:
            made[done[0]] += 1
            count -= done[1]
            if made.total() % 2000 == 0:
                for table in work.give:
                    table.squeeze()
    for p, k in work.slot.items():
        work.full[p] += work.times[k]
    return work.full, made


def arrange(histogram: dict[int, int], capacity: int, pieces: int = PIECES) -> tuple[Counter, Counter]:
    """Bins for all pieces of a histogram of lengths, and how often each kind of step was made."""
    left = Counter({s: n for s, n in histogram.items() if n})
    bins, made, unit = Counter(), Counter(), left.total()
    while left:
        unit = max(1, min(unit // 2, left.total() // pieces))
        found, steps = local_search(Counter({((s, 1),): n // unit for s, n in left.items() if n >= unit}), capacity)
        made += steps
        for p, n in found.items():
            if unit == 1 or _fill(p) == capacity:
                bins[p] += n * unit
                left.subtract({s: k * n * unit for s, k in p})
        left = +left
    return bins, made


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Segments: length, first number, how many in a bin, first sequence, offset; sorted by length and number."""
    bins, _ = arrange(histogram, capacity)
    rows, next_number, sequence = [], Counter(), 0
    for pattern, times in sorted(bins.items(), reverse=True):
        offset = 0
        for size, many in pattern:
            rows.append((size, next_number[size], many, sequence, offset))
            next_number[size] += many * times
            offset += size * many
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, length and any others) with sequence_id and offset."""
    spark = pieces.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard, first, nth, number = (fresh(pieces, x) for x in ("_shard", "_first", "_nth", "_number"))
    pieces = pieces.drop("sequence_id", "offset")
    pieces = pieces.withColumn(shard, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))
    pieces = materialise(pieces, "pieces")
    counts = pieces.groupBy("length", shard).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(counts.withColumn(first, F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most capacity rows
    shared = spark.sparkContext.broadcast(plan(histogram, capacity))
    place = Window.partitionBy("length", shard).orderBy("doc_id", "piece")
    numbered = (
        pieces.withColumn(nth, F.row_number().over(place))
        # partitioned alike by the window; a broadcast would grow with the shards
        .join(counts.select("length", shard, first).hint("merge"), ["length", shard])
        .withColumn(number, F.col(nth) - 1 + F.col(first))
        .drop(nth, first, shard)
    )

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        segments = shared.value
        size = batch.column(batch.schema.get_field_index("length")).to_numpy()
        place = batch.column(batch.schema.get_field_index(number)).to_numpy()
        key = segments[:, 0] * (1 << 44) + segments[:, 1]
        s = segments[np.searchsorted(key, size * (1 << 44) + place, "right") - 1]
        at = place - s[:, 1]
        return [pa.array(s[:, 3] + at // s[:, 2]), pa.array(s[:, 4] + at % s[:, 2] * size)]

    new = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return add_columns(numbered, new, work).drop(number)
