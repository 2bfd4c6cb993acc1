"""Bounded-space online packing of token streams into sequences.

Each partition keeps ``OPEN`` windows and takes its documents in the order in which
they come.  What of a document exceeds a sequence is cut off in whole sequences
first.  The rest goes into the window that it leaves least room in; a window that
is full is emitted.  Where none has room for it, the fullest is emitted: what it lacks is
cut from the head of the document, so that nothing is padded, and the remainder
is placed in the same way.  A gap below ``least`` tokens isn't worth a cut: with
``least`` above 1 such a window is emitted as it is and padded.

Leftovers, at most ``OPEN`` windows of a partition, are merged: laid end to end over
all partitions and cut at every full sequence.  Only the very last one isn't full;
a sequence whose length is a power of two needs no padding, so that one is cut
into powers of two.

Texts are encoded and packed in one pass and no shuffle; only leftovers carry
their ids on.  Sequence numbers are those of a partition, so a task that runs again after
a lost executor gives its whole partition again.  What the driver holds is one number for
each partition.

Defined cases: null or empty text is the end token alone; very long texts are encoded
one at a time, whole, and cut; rows that repeat are packed each; windows that tie go by the
earlier; null doc_id is an id like another; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import slices
from .scratch import materialise
from .tokens import WordIds, coder

CAPACITY = 2048
#: Open windows of a partition.
OPEN = 32
#: Sequence numbers of a partition; leftovers are numbered behind the last partition.
STRIDE = 1 << 40


class Windows:
    """The open windows of a partition.  ``place`` returns (start, length, sequence, offset) for the pieces of an item."""

    def __init__(self, first: int, capacity: int = CAPACITY, most: int = OPEN, least: int = 1):
        self.capacity, self.least, self.next = capacity, least, first + most
        # (room, number), least room first; a fresh window has room for anything that is left to place
        self.open = [(capacity, first + k) for k in range(most)]
        self.emitted: list[int] = []

    def _emit(self, k: int) -> None:
        self.emitted.append(self.open.pop(k)[1])
        self.open.append((self.capacity, self.next))  # the most room and the largest number: stays sorted
        self.next += 1

    def _put(self, k: int, length: int) -> tuple[int, int]:
        room, number = self.open[k]
        if room == length:
            self._emit(k)
        else:
            del self.open[k]
            bisect.insort(self.open, (room - length, number))
        return number, self.capacity - room

    def place(self, total: int) -> list[tuple[int, int, int, int]]:
        pieces, start = [], 0
        while total - start >= self.capacity:
            # as a window of its own, full at once
            pieces.append((start, self.capacity, self.next, 0))
            self.next += 1
            start += self.capacity
        while start < total:
            left = total - start
            k = bisect.bisect_left(self.open, (left, -1))
            if k < len(self.open):
                pieces.append((start, left, *self._put(k, left)))
                break
            room = self.open[0][0]
            if room < self.least:
                self._emit(0)
                continue
            pieces.append((start, room, *self._put(0, room)))
            start += room
        return pieces


def _schema(docs: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )


def _packed(docs: DataFrame, path: str, capacity: int, end_id: int, most: int, least: int, keep_ids: bool) -> DataFrame:
    """The pieces of all documents, with left, which tells those of leftover windows, and part."""
    base = _schema(docs)
    schema = T.StructType([*base, T.StructField("part", T.LongType()), T.StructField("left", T.BooleanType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        windows, own = Windows(part * STRIDE, capacity, most, least), coder(WordIds, path)
        waiting: dict[int, list[tuple]] = {}  # of open windows: their pieces, with ids

        def batch_of(rows: list[tuple], id_type: pa.DataType, left: bool) -> pa.RecordBatch:
            docs_, start, length, ids, tokens, sequence, offset = zip(*rows, strict=True)
            crc = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            kept = pa.array(ids if left or keep_ids else [None] * len(rows), pa.binary())
            numbers = (pa.array(x, pa.int64()) for x in (start, length, tokens, sequence, offset))
            start, length, tokens, sequence, offset = numbers
            more = [pa.array([part] * len(rows), pa.int64()), pa.array([left] * len(rows), pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(docs_, id_type), start, length, kept, crc, tokens, sequence, offset, *more], schema.fieldNames())

        id_type = None
        for batch in slices(batches, 1):
            id_type = batch.column(0).type
            found, at = own.ids(batch.column(1))
            ids_, done = batch.column(0).to_pylist(), []
            for i in range(len(batch)):
                ids = found[at[i] : at[i + 1]].tobytes() + end
                tokens = len(ids) // 4
                for start, length, sequence, offset in windows.place(tokens):
                    piece = (ids_[i], start, length, ids[4 * start : 4 * (start + length)], tokens, sequence, offset)
                    if length == capacity:
                        done.append(piece)
                        continue
                    waiting.setdefault(sequence, []).append(piece)
                for sequence in windows.emitted:
                    done += waiting.pop(sequence, [])
                windows.emitted.clear()
            if done:
                yield batch_of(done, id_type, False)
        if waiting:
            yield batch_of([p for s in sorted(waiting) for p in waiting[s]], id_type, True)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _tail(length: int) -> list[int]:
    """Powers of two that add up to length, largest first."""
    return [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]


def _merged(left: DataFrame, schema: T.StructType, capacity: int, keep_ids: bool) -> DataFrame:
    """Leftover pieces laid end to end and cut into sequences; numbers of partitions are bounded by their own."""
    totals = {r.part: r.tokens for r in left.groupBy("part").agg(F.sum("length").alias("tokens")).collect()}
    parts = np.array(sorted(totals), np.int64)
    ends = np.cumsum([totals[p] for p in parts.tolist()])
    whole = int(ends[-1]) if len(ends) else 0
    rest = whole % capacity
    cuts = whole - rest + np.cumsum([0, *_tail(rest)])  # where the last, shorter sequences begin, and the end
    first = (max(totals, default=0) + 1) * STRIDE
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["part"] != part:
                    part = r["part"]
                    k = int(np.searchsorted(parts, part))
                    at = int(ends[k - 1]) if k else 0
                done = 0
                while done < r["length"]:
                    if at < cuts[0]:
                        begin, stop, number = at - at % capacity, at - at % capacity + capacity, at // capacity
                    else:
                        k = int(np.searchsorted(cuts, at, "right")) - 1
                        begin, stop, number = int(cuts[k]), int(cuts[k + 1]), int(cuts[0]) // capacity + k
                    size = min(r["length"] - done, stop - at)
                    ids = r["ids"][4 * done : 4 * (done + size)]
                    rows.append((r["doc_id"], r["start"] + done, size, ids if keep_ids else None, zlib.crc32(ids), r["doc_tokens"], first + number, at - begin))
                    done, at = done + size, at + size
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _arrow(batch, names), strict=True)], names)

    order = ["part", "sequence_id", "offset"]
    return left.repartition("part").sortWithinPartitions(*order).mapInArrow(run, schema)


def _arrow(batch: pa.RecordBatch, names: list[str]) -> list[pa.Field]:
    return [batch.schema.field(n) for n in names]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    most: int = OPEN,
    least: int = 1,
    keep_ids: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit; null without keep_ids), ids_crc32, doc_tokens, sequence_id, offset: a row for each piece."""
    schema = _schema(docs)
    found = materialise(_packed(docs, tokenizer_path, capacity, end_id, most, least, keep_ids), "online-pieces", ["left"])
    left = found.filter("left").drop("left")
    return found.filter("NOT left").select(*schema.fieldNames()).unionByName(_merged(left, schema, capacity, keep_ids))
