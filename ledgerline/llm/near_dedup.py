"""Near-duplicate groups by MinHash with tensored banding.

A document is the set of its distinct word shingles.  Two collections of
``HALVES`` half keys are made, each key from ``ROWS`` minhashes; a table key is
a pair of half keys, one from either collection.  So HALVES**2 tables of
2 * ROWS minhashes each cost 2 * HALVES * ROWS minhashes, about the square root
of what separate tables would.  A candidate pair must agree in ``AGREE`` of the
2 * HALVES half keys.  A pair at similarity s agrees in each with probability
s**ROWS, so it is missed if no half key of one collection agrees or fewer than
AGREE in all: at 0.8 with probability 9e-5 (``miss`` works it out), at 0.85 4e-6.

1. Signatures: one pass over the texts; equal sets become one class.
2. A half key that occurs once cannot pair up: only half keys that several
   classes have are combined, so lone documents never reach the tables.
3. Shingles that no other candidate has can't be shared.  What is left of a set
   bounds its similarity to any other, and to any member of a bucket given the
   least size there: classes below the threshold leave, exactly and without a
   pair being made (a heavily edited copy in a large group, a passage in common).
4. Each bucket names as pivot the member with the largest shareable part;
   members are held against it.  A candidate pair that shares at least ``AGREE``
   half keys is confirmed on the full sets.  Confirmed links give components.
5. A bucket whose members lie in several components is still open.  Members
   outside its largest component are held against all others they might be
   similar to, found by prefix filtering: in an order that puts frequent
   shingles last, two sets similar enough share one of the first few shingles of
   either.  Edited copies have shingles of their own in front, so they meet
   almost nobody.  Pairs within a component are never needed, so copies are not
   expanded.

Defined cases: text without words, or null, has no shingle and is linked with
nothing; fewer words than a shingle make one shingle; rows that repeat get one
result each; of equal members the smallest doc_id stands for the group; a null
doc_id is linked with nothing, its component is null and it is kept; an empty
table gives no rows; very long texts are read whole, one at a time; other columns,
whatever their names, are ignored by ``groups`` and kept by ``deduplicate``.
Sets are equal if 128 bits of hash over their 64-bit shingles are; classes then
get 64-bit numbers, and the few that would share one get others.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import fresh, text_bytes
from .components import connected
from .scratch import materialise, release
from .stores import store

ROWS, HALVES, AGREE = 3, 14, 4
#: A shingle in more open sets than this comes last in the order of prefixes.
FREQUENT = 32
_BITS = 1 << 23  # of the filter for frequent shingles: it settles an order only
_LEAST, _MOST = 1 << 20, 1 << 28  # bits of other filters, sized by what they hold; beyond that they let more rows pass to an exact join
_STORE = 250_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    import xxhash

    seen = store("word hashes", dict)
    try:
        return np.array([seen[w] for w in words], np.uint64)
    except KeyError:
        if len(seen) > _STORE:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([seen[w] for w in words], np.uint64)


def shingle_set(data: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = data.lower().split() if data else []
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    n = min(size, len(h))
    acc = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        acc = _mixed((acc ^ h[k : len(h) - n + 1 + k]) * _M1)
    return np.unique(acc)


def _half_keys(s: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """2 * HALVES keys; the lowest bit tells the collection."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 8192):
        part = (s[at : at + 8192][None, :] ^ seeds[:, None]) * factors[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    low = low.reshape(2 * HALVES, ROWS)
    keys = np.arange(2 * HALVES, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed((keys ^ low[:, k]) * _M1)
    side = np.repeat(np.array([0, 1], np.uint64), HALVES)
    return ((keys & ~np.uint64(1)) | side).view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def miss(similarity: float) -> float:
    """The chance that a pair of this similarity is not among the candidates."""
    p, n = similarity**ROWS, HALVES
    one = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
    return sum(one[i] * one[j] for i in range(n + 1) for j in range(n + 1) if not i or not j or i + j < AGREE)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, whole (digest of the set, null without shingles), keys."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("whole", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType(), False)),
        ]
    )
    rng = np.random.default_rng(20)
    seeds = rng.integers(0, 2**64, 2 * HALVES * ROWS, np.uint64)
    factors = rng.integers(0, 2**64, 2 * HALVES * ROWS, np.uint64) | np.uint64(1)

    def run(batches):
        for batch in batches:
            n, whole, keys = [], [], []
            for data in text_bytes(batch.column(1)):
                s = shingle_set(data, size)
                n.append(len(s))
                whole.append(_digest(s) if len(s) else None)
                keys.append(_half_keys(s, seeds, factors) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(whole, pa.binary()),
                    pa.array(keys, pa.list_(pa.field("element", pa.int64(), False))),
                ],
                schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)


def _numbered(classes: DataFrame) -> DataFrame:
    """classes with cid, a number of its own for each digest."""
    number, salt = F.xxhash64("whole"), 0
    while True:
        numbered = classes.withColumn("cid", number)
        # digests that share 64 bits: none in practice, n**2 / 2**65 among n are expected
        twice = [r[0] for r in numbered.groupBy("cid").agg(F.count("*").alias("n")).filter("n > 1").select("cid").collect()]
        if not twice:
            return numbered
        salt += 1
        number = F.when(number.isin(twice), F.xxhash64("whole", F.lit(salt))).otherwise(number)


def _room(n: int) -> int:
    """Bits of a filter for n keys: eight for each, a power of two."""
    return min(_MOST, max(_LEAST, 1 << (8 * n).bit_length()))


def _filter_bits(values: DataFrame, spot: F.Column, bits: int) -> np.ndarray:
    """A bit for each spot (0 to bits - 1) that occurs, packed; at most bits / 32768 rows of 4 KB reach the driver."""
    maps = (
        values.select(spot.alias("s"))
        .groupBy(F.floor(F.col("s") / 32768).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("s") % 32768).alias("bits"))
        .collect()
    )
    table = np.zeros((bits // 32768, 4096), np.uint8)
    for part, found in maps:
        table[part] = np.frombuffer(found, np.uint8)
    return table.reshape(-1)


def _sets(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """cid, members: the sets of the documents named in wanted (doc_id, whole, cid).

    The texts are filtered where they are; only sets are shuffled, and of those
    few that nobody wants.
    """
    bits = _room(wanted.count())
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted, spot, bits))

    def run(batches):
        table = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((table[at >> 3] >> (at & 7)) & 1 > 0))
            for row in range(0, len(batch), 256):
                part = batch.slice(row, 256)
                found = [shingle_set(x, size) for x in text_bytes(part.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.array([_digest(s) for s in found], pa.binary()),
                        pa.array([s.view(np.int64) for s in found], pa.list_(pa.field("element", pa.int64(), False))),
                    ],
                    ["doc_id", "whole", "members"],
                )

    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("whole", T.BinaryType()),
            T.StructField("members", T.ArrayType(T.LongType(), False)),
        ]
    )
    found = docs.filter("doc_id IS NOT NULL").select(spot.alias("s"), "doc_id", "text").mapInArrow(run, schema)
    return found.join(wanted, ["doc_id", "whole"]).dropDuplicates(["doc_id", "whole"]).select("cid", "members")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b) those whose similarity is at least percent: u, v, each (doc_id, cid)."""
    side = lambda x: classes.select(
        F.col("cid").alias(x),
        F.col("doc_id").alias(f"doc_{x}"),
        F.col("keys").alias(f"keys_{x}"),
        F.col("n_shingles").alias(f"n_{x}"),
    )
    near = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .filter(F.expr(f"size(filter(arrays_zip(keys_a, keys_b), k -> k.keys_a = k.keys_b)) >= {AGREE}"))
        .select("a", "b", "doc_a", "doc_b", "n_a", "n_b")
    )
    whole = lambda x: sets.select(F.col("cid").alias(x), F.col("members").alias(f"set_{x}"))
    return (
        near.join(whole("a"), "a")
        .join(whole("b"), "b")
        .withColumn("both", F.size(F.array_intersect("set_a", "set_b")))
        .filter(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both")))
        .select(*[F.struct(F.col(f"doc_{x}").alias("doc_id"), F.col(x).alias("cid")).alias(y) for x, y in ("au", "bv")])
    )


def _tables(classes: DataFrame) -> DataFrame:
    """bucket, cid: the table buckets with several classes."""
    half = classes.select("cid", F.explode("keys").alias("key"))
    often = half.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    live = half.join(often, "key", "left_semi")
    sides = live.groupBy("cid").agg(F.collect_list("key").alias("keys"))  # at most 2 * HALVES
    pairs = F.expr(
        "flatten(transform(filter(keys, k -> k & 1 = 0), a -> transform(filter(keys, k -> k & 1 = 1), b -> xxhash64(a, b))))"
    )
    return sides.select("cid", F.explode(pairs).alias("bucket"))


def _shareable(sets: DataFrame) -> DataFrame:
    """cid, n, share: the size of each set, and how many of its shingles some other set has too."""
    once = (
        sets.select("cid", F.explode("members").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), F.max("cid").alias("cid"))
        .filter("n = 1")
    )
    alone = once.groupBy("cid").agg(F.count("*").alias("alone"))
    size = F.size("members").cast("long")
    return sets.select("cid", size.alias("n")).join(alone, "cid", "left").select(
        "cid", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("share")
    )


def _within_reach(tables: DataFrame, kin: DataFrame, percent: int) -> DataFrame:
    """bucket, cid, n, share, pivot: the rows of buckets whose members may be similar to another member.

    A shared part of share shingles allows, beside a set of m, at most
    share / (n + m - share); m is no less than the least size in the bucket and
    than percent of n.
    """
    rows = tables.join(kin.filter(100 * F.col("share") >= percent * F.col("n")), "cid")
    sizes = rows.groupBy("bucket").agg(F.min("n").alias("low"), F.count("*").alias("many")).filter("many > 1")
    rows = rows.join(sizes.select("bucket", "low"), "bucket")
    least = F.greatest(100 * F.col("low"), percent * F.col("n"))
    rows = rows.filter(100 * (100 + percent) * F.col("share") >= percent * (100 * F.col("n") + least)).drop("low")
    rank = F.struct((F.col("share") / F.col("n")).alias("s"), "cid")
    pivots = rows.groupBy("bucket").agg(F.max_by("cid", rank).alias("pivot"), F.count("*").alias("many")).filter("many > 1")
    return rows.join(pivots.select("bucket", "pivot"), "bucket")


def _open(tables: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, cid, n, share, root of the buckets whose members lie in several components."""
    roots = roots.select(F.col("node.cid").alias("node"), F.col("root.cid").alias("root"))
    named = tables.select("bucket", "cid", "n", "share").join(roots, F.col("cid") == F.col("node"), "left")
    named = named.select("bucket", "cid", "n", "share", F.coalesce("root", "cid").alias("root"))
    state = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return named.join(state.select("bucket"), "bucket", "left_semi")


def _prefixes(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """shingle, cid, root, outside: the first shingles of each class of open buckets.

    outside: the class isn't in the largest component of some bucket.  The
    order is a function of the shingle: frequent ones last, then by hash.
    """
    sizes = left.groupBy("bucket", "root").agg(F.count("*").alias("many"), F.min("n").alias("low"))
    largest = sizes.groupBy("bucket").agg(
        F.max_by("root", F.struct("many", "root")).alias("largest"), F.min("low").alias("low")
    )
    classes = (
        left.join(largest, "bucket")
        .groupBy("cid")
        .agg(F.min("root").alias("root"), F.min("n").alias("n"), F.min("low").alias("low"), F.max(F.col("root") != F.col("largest")).alias("outside"))
    )
    least = F.greatest(100 * F.col("low"), percent * F.col("n"))
    need = F.ceil((percent * (100 * F.col("n") + least)) / (100 * (100 + percent)))
    held = classes.select("cid", "root", "outside", (F.col("n") - need + 1).alias("first")).join(sets, "cid")
    held = materialise(held, "open-sets")
    counts = held.select(F.explode("members").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    spot = F.pmod(F.col("shingle"), F.lit(_BITS))
    shared = left.sparkSession.sparkContext.broadcast(_filter_bits(counts.filter(F.col("n") > FREQUENT), spot, _BITS))
    schema = T.StructType([T.StructField("shingles", T.ArrayType(T.LongType(), False)), *[held.schema[c] for c in ("cid", "root", "outside")]])

    def run(batches):
        bits = shared.value
        for batch in batches:
            rows = []
            for members, first in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                s = members.values.to_numpy()
                at = s % _BITS
                often = (bits[at >> 3] >> (at & 7)) & 1
                rows.append(s[np.lexsort((s, often))[: max(0, first)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.field("element", pa.int64(), False))), *batch.columns[2:]], schema.fieldNames()
            )

    found = held.select("members", "first", "cid", "root", "outside").mapInArrow(run, schema)
    return found.select(F.explode("shingles").alias("shingle"), "cid", "root", "outside")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (smallest doc_id of the group): a row for each row of docs."""
    signed = materialise(signatures(docs, size), "signatures")
    same = (
        signed.filter("whole IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("whole")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
    )
    classes = _numbered(materialise(same, "classes"))
    raw = materialise(_tables(classes), "tables-all")
    several = raw.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    met = materialise(raw.join(several, "bucket", "left_semi"), "tables-met")
    release(raw)
    wanted = met.select("cid").distinct().join(classes, "cid").select("doc_id", "whole", "cid")
    sets = materialise(_sets(docs, size, materialise(wanted, "wanted")), "sets")
    kin = materialise(_shareable(sets), "shareable")
    tables = materialise(_within_reach(met, kin, percent), "tables")
    release(met)

    pairs = _pairs(tables.filter("cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b")))
    links = materialise(_confirmed(pairs, classes, sets, percent), "links")
    roots = connected(links)
    left = materialise(_open(tables, roots), "open")
    if not left.isEmpty():
        fronts = materialise(_prefixes(left, sets, percent), "prefixes")
        mine = fronts.filter("outside").select("shingle", F.col("cid").alias("a"), F.col("root").alias("r1"))
        other = fronts.select("shingle", F.col("cid").alias("b"), F.col("root").alias("r2"))
        met = mine.join(other, "shingle").filter("r1 <> r2").select("a", "b")
        more = materialise(_confirmed(_pairs(met), classes, sets, percent), "links")
        if not more.isEmpty():
            roots = connected(links.unionByName(more))
    # a root is the smallest (doc_id, cid) of its component, so it names the group without another join
    roots = roots.select(F.col("node.cid").alias("cid"), F.col("root.doc_id").alias("least"))
    names = classes.select("whole", "cid", "doc_id").join(roots, "cid", "left")
    names = materialise(names.select("whole", F.coalesce("least", "doc_id").alias("component_id")), "components")
    for done in (sets, tables):
        release(done)
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "whole")
        .join(names, "whole", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
    )


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group: that of the smallest doc_id (of equal ones, one).

    A document whose id is its group's name and occurs once stays where it is.
    Ids that go or occur again are marked in a filter sized by their number; only the
    rows it marks are shuffled, and settled by an exact join.
    """
    found = materialise(groups(docs, size, percent).filter("doc_id IS NOT NULL"), "groups")
    doubtful = (
        found.groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.max(F.col("doc_id") != F.col("component_id")).alias("goes"))
        .filter("goes OR n > 1")
    )
    doubtful = materialise(doubtful.select("doc_id"), "doubtful")
    bits = _room(doubtful.count())
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_bits(doubtful, spot, bits))

    @F.pandas_udf(T.BooleanType())
    def marked(at: pd.Series) -> pd.Series:
        return pd.Series((shared.value[at.to_numpy() >> 3] >> (at.to_numpy() & 7)) & 1 > 0)

    first = found.filter("doc_id = component_id")
    keep = (
        first.filter("n_shingles > 0")
        .groupBy("doc_id")
        .agg(F.min("text_hash").alias("text_hash"))
        .unionByName(first.filter("n_shingles = 0").select("doc_id", "text_hash").distinct())
    )
    own, text_hash, mark = (fresh(docs, x) for x in ("_id", "_text_hash", "_marked"))
    keep = materialise(keep.select(F.col("doc_id").alias(own), F.col("text_hash").alias(text_hash)), "kept")
    rows = docs.withColumn(mark, F.col("doc_id").isNotNull() & marked(spot))
    stay = rows.filter(~F.col(mark))
    settled = rows.filter(F.col(mark)).withColumns({own: F.col("doc_id"), text_hash: F.xxhash64("text")})
    settled = settled.join(keep, [own, text_hash], "left_semi").dropDuplicates([own, text_hash])
    return stay.select(*docs.columns).unionByName(settled.select(*docs.columns))
