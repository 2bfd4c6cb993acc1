"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features: hashed character n-grams (lengths ``SIZES``) of each distinct
lower-cased word of a text, with a space at either end; a feature counts the
distinct words that hold it, over the fourth root of the number of distinct
words.  Each feature is scaled by the log ratio of its smoothed shares in toxic
and other texts, and a logistic regression is trained on the scaled features.
A word's part in the score is the sum over its n-grams, so it is worked out
once and kept.

``fit`` learns from at most ``ROWS_PER_CLASS`` labelled documents of each class
(those first by hash of their id), weighted back to the labels' own shares, and
of each from at most ``BYTES_PER_ROW`` bytes of distinct words (those first by
hash): the executors cut the words, so what the driver gathers is bounded.
Every text is scored whole.

Defined cases: null or empty text scores what the intercept says; labels that
contradict count as toxic; without labels of both classes the score is the
smoothed share of toxic labels (0.5 without any); rows that repeat are rows of
their own and score alike, of rows that repeat an id one is learned from; a null
doc_id is scored and not held out; very long texts are scored whole; equal scores stay
equal; an empty table gives no rows; other columns, whatever their names, pass
through, one named as the result is replaced.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import add_columns
from .stores import store

ROWS_PER_CLASS, BYTES_PER_ROW = 2500, 32_768
BITS, SIZES, SMOOTHING, LENGTH, RATE = 18, (3, 4, 5, 6), 50.0, 0.25, 0.03
_STORE, _AT_ONCE = 250_000, 256


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of the words, and the word that each is of; in order of words."""
    text = " " + " ".join(words) + " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    space = points == 32
    word_of = np.cumsum(space) - 1
    found, owners = [], []
    for n in SIZES:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inner = np.concatenate(([0], np.cumsum(space)))
        # spaces may stand at the ends of an n-gram only
        whole = inner[n - 1 : len(points)] - inner[1 : len(points) - n + 2] == 0
        found.append((h[whole] >> np.uint64(64 - BITS)).astype(np.int32))
        owners.append(word_of[: len(points) - n + 1][whole])
    f, o = np.concatenate(found or [np.empty(0, np.int32)]), np.concatenate(owners or [np.empty(0, np.int64)])
    order = np.argsort(o, kind="stable")
    return f[order], o[order]


def distinct_words(text: str | None) -> list[str]:
    return list(dict.fromkeys(text.lower().split())) if text else []


def train(words: list[list[str]], toxic: np.ndarray, prior: float, epochs: int = 15) -> tuple[np.ndarray, float]:
    """Weights by feature (scales included) and intercept."""
    features = [grams(w)[0] for w in words]
    size = 1 << BITS
    shares = []
    for y in (1, 0):
        # prior counts in proportion to the class: a feature seen once says little, whichever class is larger
        share = (toxic == y).mean()
        count = np.full(size, SMOOTHING * share)
        for f, t in zip(features, toxic, strict=True):
            if t == y:
                count[np.unique(f)] += 1
        shares.append(count / ((toxic == y).sum() + SMOOTHING * share))
    ratio = np.log(shares[0] / shares[1])
    scale = np.array([max(1, len(w)) ** -LENGTH for w in words])
    # the sample's classes weigh as the labels' do
    weight = np.where(toxic == 1, prior / max(toxic.mean(), 1e-9), (1 - prior) / max(1 - toxic.mean(), 1e-9))
    beta, bias, seen = np.zeros(size), float(np.log(prior / (1 - prior))), np.full(size, 1e-6)
    seen_bias = 1e-6
    rng = np.random.default_rng(9)
    for _ in range(epochs):
        order = rng.permutation(len(words))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            joined = np.concatenate([features[i] for i in rows])
            counts = np.array([len(features[i]) for i in rows])
            owner = np.repeat(np.arange(len(rows)), counts)
            z = bias + np.bincount(owner, (beta * ratio)[joined], len(rows)) * scale[rows]
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[rows]) * weight[rows] / len(rows)
            step = np.bincount(joined, (error * scale[rows])[owner], size) * ratio + 1e-7 * beta
            seen += step**2
            beta -= RATE * step / np.sqrt(seen)
            seen_bias += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return beta * ratio, bias


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the documents whose labels are never learned from; false for a null id, which no label names."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learns(doc_id: Column, folds: int = 5) -> Column:
    """True for the documents that labels may be learned from."""
    return ~held_out(doc_id, folds)


def _some_words(text: str | None, most: int) -> list[str]:
    """The distinct words of a text; of more than ``most`` bytes, those first by hash that fit."""
    words = distinct_words(text)
    if sum(len(w.encode("utf-8", "surrogatepass")) + 1 for w in words) <= most:
        return words
    some, room = [], most
    for w in sorted(words, key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w)):
        size = len(w.encode("utf-8", "surrogatepass")) + 1
        if size <= room:
            some.append(w)
            room -= size
    return some


def fit(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, bytes_per_row: int = BYTES_PER_ROW
) -> tuple[np.ndarray, float]:
    """Weights and intercept, from labelled documents for which ``learns`` holds."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(learns(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    shares = {r[0]: r[1] for r in known.groupBy("toxic").agg(F.count("*")).collect()}  # two rows
    total = sum(shares.values())
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    prior = (shares.get(1, 0) + 1) / (total + 2)
    nothing = np.zeros(1 << BITS), float(np.log(prior / (1 - prior)))
    if not (shares.get(0) and shares.get(1)):
        return nothing
    # at most 2 * rows_per_class ids; of an id that repeats, one text
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    rows = rows.agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches):
        for batch in batches:
            words = [" ".join(_some_words(t.as_py(), bytes_per_row)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.string())], schema.fieldNames())

    schema = T.StructType([rows.schema["doc_id"], rows.schema["toxic"], T.StructField("words", T.StringType())])
    found = sorted(rows.mapInArrow(run, schema).collect(), key=lambda r: str(r.doc_id))  # bytes_per_row each at most
    toxic = np.array([r.toxic for r in found], np.int64)
    if not 0 < toxic.sum() < len(toxic):
        return nothing
    return train([r.words.split() for r in found], toxic, prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float], result: str = "score") -> DataFrame:
    """docs with the column ``result``: the chance that a text is toxic."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    tag = uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        kept = store(tag, dict)
        texts = batch.column(batch.schema.get_field_index("text"))
        z = np.empty(len(texts))
        for at in range(0, len(texts), _AT_ONCE):
            words = [set(t.lower().split()) if t else () for t in texts.slice(at, _AT_ONCE).to_pylist()]
            if len(kept) > _STORE:
                kept.clear()
            new = list(set().union(*words).difference(kept))
            if new:
                features, owner = grams(new)
                kept.update(zip(new, np.bincount(owner, shared.value[features], len(new)).tolist(), strict=True))
            for i, w in enumerate(words):
                z[at + i] = bias + sum([kept[x] for x in w]) / max(1, len(w)) ** LENGTH
        return [pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))]

    return add_columns(docs, [T.StructField(result, T.DoubleType())], work)
