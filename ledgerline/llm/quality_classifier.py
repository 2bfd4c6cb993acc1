"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (one and two words; signs are
words of their own): one of the target text (documents labelled good), one of
the raw text (all documents).  A document's log weight is the sum over its
n-grams of the log ratio of their chances; Gumbel noise, drawn by hash from the
document's id, is added, and the ``k`` documents of the largest sums are kept:
a sample without replacement in proportion to the weights.

k follows the labels: it is the number of documents whose log weight is at least
that which all but ``LOSS`` of the documents labelled good have.

The raw model counts every n-gram of every document.  The target model learns
from at most ``TARGET_ROWS`` labelled documents (those first by hash of their id).
The k-th largest sum is found by narrowing histograms, then exactly.

Defined cases: null or empty text has weight 0; documents that tie with the
k-th are kept; rows that repeat tie; a null doc_id draws noise as an id of its
own; without good labels everything is kept; labels that contradict count as
bad; very long texts are read whole, one at a time; other columns, whatever their names, are
ignored by ``resample`` and kept by ``select``; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import add_columns, fresh
from .scratch import materialise
from .stores import store

TARGET_ROWS, BUCKETS, LOSS, SEED = 20_000, 1 << 15, 0.002, 17
_WORD = re.compile(r"\w+|[^\w\s]+")
_STORE = 250_000


def buckets(text: str | None) -> np.ndarray:
    """The bucket of every n-gram of a text."""
    import xxhash

    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.int64)
    seen = store("sign and word hashes", dict)
    try:
        h = np.array([seen[w] for w in words], np.uint64)
    except KeyError:
        if len(seen) > _STORE:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.array([seen[w] for w in words], np.uint64)
    two = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    two = (two ^ (two >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (np.concatenate((h, two)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def good_ids(labels: DataFrame) -> DataFrame:
    """doc_id of the documents labelled good and never bad."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio of each bucket."""
    chosen = good_ids(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)
    ids = docs.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in chosen.collect()))  # at most target_rows
    schema = T.StructType(
        [T.StructField("bucket", T.IntegerType()), T.StructField("raw", T.LongType()), T.StructField("target", T.LongType())]
    )

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                b = buckets(text.as_py())
                raw += np.bincount(b, minlength=BUCKETS) if len(b) > BUCKETS // 8 else 0
                if len(b) <= BUCKETS // 8:
                    np.add.at(raw, b, 1)
                if doc in ids.value:
                    np.add.at(target, b, 1)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])], schema.fieldNames()
        )

    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    for r in found.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # at most BUCKETS rows
        raw[r[0]] += r[1]
        target[r[0]] += r[2]
    if not ids.value:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray, result: str = "log_weight") -> DataFrame:
    """docs with the log weight of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index("text"))
        return [pa.array([float(shared.value[buckets(t.as_py())].sum()) for t in texts], pa.float64())]

    return add_columns(docs, [T.StructField(result, T.DoubleType())], work)


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, exactly; None if there are fewer.  Bounded results reach the driver."""
    v = F.col(column)
    n, low, high = values.agg(F.count(v), F.min(v), F.max(v)).first()
    if k < 1 or k > n:
        return None
    while n > 10_000 and low < high:
        width = (high - low) / 1000
        spot = F.least(F.floor((v - low) / width), F.lit(999))
        inside = values.filter(v.between(low, high))
        bins = inside.groupBy(spot.alias("s")).agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        for r in sorted(bins.collect(), key=lambda r: -r.s):
            if k <= r.n:
                n, low, high = r.n, r.lo, r.hi
                break
            k -= r.n
    if low == high:
        return low
    return values.filter(v.between(low, high)).orderBy(v.desc()).limit(k).collect()[-1][column]


def _keyed(docs: DataFrame, ratios: np.ndarray, weight: str = "_log_weight", key: str = "_gumbel_key") -> DataFrame:
    """docs with the log weight and the Gumbel key."""
    unit = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return weigh(docs, ratios, weight).withColumn(key, F.col(weight) - F.log(-F.log(unit)))


def _cut(keyed: DataFrame, labels: DataFrame, loss: float) -> float | None:
    """The k-th largest key; None: all are kept.  keyed: doc_id, _log_weight, _gumbel_key."""
    good = materialise(keyed.join(good_ids(labels), "doc_id", "left_semi").select("_log_weight"), "good-weights")
    least = kth_largest(good, "_log_weight", int(np.ceil(good.count() * (1 - loss))))
    if least is None:
        return None
    return kth_largest(keyed.select("_gumbel_key"), "_gumbel_key", keyed.filter(F.col("_log_weight") >= least).count())


def resample(docs: DataFrame, labels: DataFrame, loss: float = LOSS) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept: a row for each row of docs."""
    keyed = materialise(_keyed(docs.select("doc_id", "text"), fit(docs, labels)).drop("text"), "importance")
    cut = _cut(keyed, labels, loss)
    kept = F.col("_gumbel_key") >= cut if cut is not None else F.lit(True)
    return keyed.select(
        "doc_id", F.col("_log_weight").alias("log_weight"), F.col("_gumbel_key").alias("gumbel_key"), kept.alias("kept")
    )


def select(docs: DataFrame, labels: DataFrame, loss: float = LOSS) -> DataFrame:
    """The rows of docs that are kept.

    The rows are written beside their keys, so texts are weighed once and
    filtered where they are; a join with the kept ids would move all of them.
    """
    weight, key = fresh(docs, "_log_weight"), fresh(docs, "_gumbel_key")
    keyed = materialise(_keyed(docs, fit(docs, labels), weight, key), "importance")
    small = keyed.select("doc_id", F.col(weight).alias("_log_weight"), F.col(key).alias("_gumbel_key"))
    cut = _cut(small, labels, loss)
    return (keyed if cut is None else keyed.filter(F.col(key) >= cut)).select(*docs.columns)
