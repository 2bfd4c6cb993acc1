"""Benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised (A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``);
each run of ``window`` words of a benchmark item is a key of the automaton, an
item of fewer words a key of its own.  The automaton's letters are word
numbers of the benchmark's vocabulary, so a text is scanned once, a step a
word; places are mapped back to code points of the original text.

The benchmark is a stated query set; its texts are collected and broadcast.
One automaton holds all of it and is built once by each Python worker, at about
110 MB and 4 s for each MB of text.  Only a benchmark of more than ``GROUP``
bytes, which no worker could hold as an automaton, is dealt by item into groups
of that size, each with an automaton and a pass of its own.

Defined cases: null or empty text has no words and no hit; an item without
words, or with null id, is ignored; items that repeat count once, equal windows
of several items count for each; rows that repeat are rows of their own; very
long texts are scanned whole, batches in slices of bounded size; other columns pass through,
whatever their names; a column named as the result is replaced.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .arrow_rows import add_columns, fresh, text_bytes
from .scratch import materialise
from .stores import store

WINDOW = 10
GROUP = 4 << 20
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _result(item_id: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("item_ids", T.ArrayType(item_id)),
            T.StructField(
                "spans",
                T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
            ),
        ]
    )


def normalised_words(data: bytes | None) -> list[bytes]:
    """The words of a text, as UTF-8 bytes."""
    return data.translate(_FOLD).split() if data else []


class Matcher:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[tuple], window: int):
        import ahocorasick

        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normalised_words(text.encode())]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.windows = [(len(k), v) for k, v in owners.items()]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for n, key in enumerate(owners):
            self.automaton.add_word(key, n)
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes], hit: np.ndarray | None, items: set) -> np.ndarray | None:
        """Marks the words inside windows; adds the items whose windows occur."""
        if not self.windows or not words:
            return hit
        get = self.vocabulary.get
        last = -1
        for end, n in self.automaton.iter(tuple([get(w, 0) for w in words])):
            length, owners = self.windows[n]
            if hit is None:
                hit = np.zeros(len(words), bool)
            hit[max(end - length, last - length) + 1 : end + 1] = True
            last = end
            items |= owners
        return hit


def original_spans(data: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the original text."""
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [
        {"start": int(points[places[a][0]]), "end": int(points[places[b - 1][1]])} for a, b in edges.reshape(-1, 2)
    ]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, result: str = "decontamination") -> DataFrame:
    """docs with the struct column ``result``: n_words, n_hit, item_ids (sorted), spans (code points)."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = 1 if size <= GROUP else -(-size // (GROUP // 2))
    for k in range(groups):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == k) if groups > 1 else items
        docs = _scan_group(docs, sorted(map(tuple, part.collect())), items.schema["item_id"].dataType, window, result, first=k == 0)
        if k < groups - 1:
            docs = materialise(docs, "decontamination")
    return docs


def _scan_group(docs: DataFrame, items: list[tuple], kind: T.DataType, window: int, result: str, first: bool) -> DataFrame:
    id_type = to_arrow_type(kind)
    shared = docs.sparkSession.sparkContext.broadcast(items)
    tag = uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        own = store(tag, lambda: Matcher(shared.value, window))
        texts = text_bytes(batch.column(batch.schema.get_field_index("text")))
        n_words, n_hit, found, spans = [], [], [], []
        for i, data in enumerate(texts):
            words = normalised_words(data)
            ids: set = set()
            hit = own.scan(words, None, ids)
            n_words.append(len(words))
            n_hit.append(int(hit.sum()) if hit is not None else 0)
            found.append(ids)
            spans.append(original_spans(data, hit) if hit is not None else [])
        if not first:
            for i, x in enumerate(batch.column(batch.schema.get_field_index(result)).to_pylist()):
                found[i] |= set(x["item_ids"])
                if x["spans"]:
                    n_hit[i], spans[i] = _united(texts[i], spans[i] + x["spans"])
        made = pa.StructArray.from_arrays(
            [
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([sorted(s) for s in found], pa.list_(id_type)),
                pa.array(spans, pa.list_(_SPAN)),
            ],
            ["n_words", "n_hit", "item_ids", "spans"],
        )
        return [made]

    return add_columns(docs, [T.StructField(result, _result(kind))], work, "text")


def _united(data: bytes, spans: list[dict]) -> tuple[int, list[dict]]:
    """Spans of several chunks as one: words hit, runs."""
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    starts = points[[a for a, _ in places]]
    hit = np.zeros(len(places), bool)
    for s in spans:
        hit[np.searchsorted(starts, s["start"]) : np.searchsorted(starts, s["end"])] = True
    return int(hit.sum()), original_spans(data, hit)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with their own columns."""
    name = fresh(docs, "decontamination")
    return scan(docs, benchmark, window, name).filter(F.col(f"{name}.n_hit") == 0).select(*docs.columns)
