"""Language-model scores by subword lattices.

The vocabulary is an existing one; a word is scored by the sum over *all* its
segmentations into pieces, worked out by the forward recursion in log space.
The vocabulary file holds merge ranks, not probabilities, so the pieces'
unigram scores are their smoothed shares in the training words as the existing
vocabulary cuts them; the end of a text is one more event of that distribution.
Characters that no piece covers are spelled in the vocabulary's byte pieces, so
every text has a probability.  Words do not share pieces, so the probability of
a text is the product over its words and its end.

Beside it stands an add-one word model (the base), from the same counts.

``lexicon`` counts the words of all documents (training and held-out apart),
a row for each distinct word; piece shares and lattice scores are worked out
once for each row of it.  ``score`` reads the texts once more: words that are
frequent enough to be among at most ``HOT`` are looked up in a broadcast table of
that bound, all others are joined with the lexicon and summed by document.

Defined cases: null or empty text is its end alone; A-Z are lower-cased, words
are ``[^\\x20\\x09-\\x0D]+``; rows that repeat get one result each; null doc_id is
not held out (it has no remainder) and is learned from; without training text
N is 0; words that tie in frequency are taken or left together by the look-up;
very long texts are read whole, one at a time, and a very long word is one lattice, in
time proportional to its length; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import text_bytes
from .scratch import materialise
from .stores import store

HOT = 400_000
ALPHA = 0.1
_FULL = 500_000
_MARK = "▁"
LOG10 = math.log(10)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n_train, n_all; docs: text, held_out.  Counts are combined in each task before the shuffle."""
    schema = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("held", T.BooleanType())]
    )

    def rows(counts: Counter, held: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [_strings(list(counts)), pa.array(list(counts.values()), pa.int64()), pa.array([held] * len(counts), pa.bool_())],
            schema.fieldNames(),
        )

    def run(batches):
        counts = {True: Counter(), False: Counter()}
        for batch in batches:
            for data, held in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if data:
                    counts[held].update(data.lower().split())
                    if len(counts[held]) > _FULL:
                        yield rows(counts[held], held)
                        counts[held].clear()
        for held, c in counts.items():
            yield rows(c, held)

    found = docs.select("text", "held_out").mapInArrow(run, schema)
    return found.groupBy("word").agg(
        F.sum(F.when(F.col("held"), 0).otherwise(F.col("n"))).alias("n_train"), F.sum("n").alias("n_all")
    )


def piece_counts(lexicon: DataFrame, model_path: str) -> np.ndarray:
    """How often each piece of the vocabulary occurs in the training words, as the vocabulary cuts them."""
    schema = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=model_path)
        total = np.zeros(own.get_piece_size(), np.int64)
        for batch in batches:
            ids = own.encode(batch.column(0).to_pylist(), num_threads=1)
            counts = batch.column(1).to_numpy()
            flat = np.fromiter((i for x in ids for i in x), np.int64)
            times = np.repeat(counts, [len(x) for x in ids])
            np.add.at(total, flat, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["piece", "n"])

    import sentencepiece

    found = lexicon.filter("n_train > 0").select("word", "n_train").mapInArrow(run, schema)
    total = np.zeros(sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size(), np.int64)
    for piece, n in found.groupBy("piece").agg(F.sum("n")).collect():  # at most a row for each piece
        total[piece] = n
    return total


class Lattice:
    """Marginal log probabilities of words over all segmentations."""

    def __init__(self, model_path: str, counts: np.ndarray, n_texts: int):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usable = [i for i in range(own.get_piece_size()) if not (own.is_control(i) or own.is_unknown(i))]
        total = counts[usable].sum() + n_texts + ALPHA * (len(usable) + 1)
        self.end = math.log((n_texts + ALPHA) / total)
        self.byte, self.piece = [0.0] * 256, {}
        for i in usable:
            said, p = own.id_to_piece(i), math.log((counts[i] + ALPHA) / total)
            if own.is_byte(i):
                self.byte[int(said[3:5], 16)] = p
            elif _MARK not in said[1:]:
                self.piece[said] = p
        self.longest = max(map(len, self.piece))
        self.single: dict[str, float] = {}

    def _one(self, c: str) -> float:
        """A character as a piece or spelled in bytes."""
        if c not in self.single:
            spelled = sum(self.byte[b] for b in c.encode())
            p = self.piece.get(c)
            self.single[c] = spelled if p is None else np.logaddexp(p, spelled).item()
        return self.single[c]

    def log_prob(self, word: str) -> float:
        s = _MARK + word
        forward = [0.0]
        get, exp, log, longest = self.piece.get, math.exp, math.log, self.longest
        for i in range(1, len(s) + 1):
            best = forward[i - 1] + self._one(s[i - 1])
            more = None
            for j in range(max(0, i - longest), i - 1):
                p = get(s[j:i])
                if p is not None:
                    if more is None:
                        more = [best]
                    more.append(forward[j] + p)
            if more:
                top = max(more)
                best = top + log(sum([exp(x - top) for x in more]))
            forward.append(best)
        return forward[-1]


def with_lattice(lexicon: DataFrame, model_path: str, counts: np.ndarray, n_texts: int) -> DataFrame:
    """lexicon with lattice: log10 of the probability of each word."""
    shared = lexicon.sparkSession.sparkContext.broadcast(counts)
    schema = T.StructType(lexicon.schema.fields + [T.StructField("lattice", T.DoubleType())])

    def run(batches):
        own = Lattice(model_path, shared.value, n_texts)
        for batch in batches:
            found = [own.log_prob(w) / LOG10 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], schema.fieldNames())

    return lexicon.mapInArrow(run, schema)


def _frequent(lexicon: DataFrame, most: int) -> DataFrame:
    """The words of the highest steps of frequency, at most ``most`` of them."""
    step = F.floor(F.log2("n_all") * 16)
    seen, low = 0, None
    steps = lexicon.groupBy(step.alias("s")).agg(F.count("*").alias("n"))  # at most 16 * 64 rows
    for r in sorted(steps.collect(), key=lambda r: -r.s):
        seen += r.n
        if seen > most:
            break
        low = r.s
    return lexicon.filter(step >= low) if low is not None else lexicon.filter(F.lit(False))


def score(docs: DataFrame, model_path: str, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of docs."""
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    lexicon = materialise(word_counts(docs), "word-counts")
    sums = lexicon.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))).first()
    n_texts = docs.filter("NOT held_out").count()
    total = sums[0] + n_texts
    distinct = sums[1] + (n_texts > 0)
    counts = piece_counts(lexicon, model_path)
    lexicon = materialise(with_lattice(lexicon, model_path, counts, n_texts), "lexicon")
    denominator = float(total + distinct + 1)
    known = _frequent(lexicon, hot).select("word", "n_train", "lattice").toArrow()  # at most ``hot`` rows
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as writer:
        writer.write_table(known)
    shared = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
    tag = uuid.uuid4().hex
    end_base = math.log10((n_texts + 1) / denominator)
    end_lattice = Lattice(model_path, counts, n_texts).end / LOG10
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("text_hash", T.LongType()),
            T.StructField("word", T.StringType()),
            T.StructField("times", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("lattice", T.DoubleType()),
        ]
    )

    def table() -> dict[bytes, tuple[bool, float, float]]:
        with pa.ipc.open_stream(shared.value) as reader:
            t = reader.read_all()
        n = t.column(1).to_numpy()
        words = t.column(0).cast(pa.binary()).to_pylist()
        rows = zip((n > 0).tolist(), np.log10((n + 1) / denominator).tolist(), t.column(2).to_pylist(), strict=True)
        return dict(zip(words, rows, strict=True))

    def run(batches):
        get = store(tag, table).get
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                row, word, times, n_tokens, n_known, base, lattice = [], [], [], [], [], [], []
                for i, data in enumerate(text_bytes(part.column(1))):
                    words = data.lower().split() if data else []
                    known_, base_, lattice_ = int(n_texts > 0), end_base, end_lattice
                    row.append(i)
                    # the document's own row: a word with a space in it meets none
                    word.append(b" %d" % (at + i))
                    times.append(0)
                    mine = len(n_tokens)
                    n_tokens.append(len(words) + 1)
                    n_known.append(0)
                    base.append(0.0)
                    lattice.append(0.0)
                    for w, k in Counter(words).items():
                        found = get(w)
                        if found is None:
                            row.append(i)
                            word.append(w)
                            times.append(k)
                            n_tokens.append(0)
                            n_known.append(0)
                            base.append(0.0)
                            lattice.append(0.0)
                        else:
                            known_ += k * found[0]
                            base_ += k * found[1]
                            lattice_ += k * found[2]
                    n_known[mine], base[mine], lattice[mine] = known_, base_, lattice_
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(take),
                        part.column(2).take(take),
                        _strings(word),
                        *[pa.array(x, pa.int64()) for x in (times, n_tokens, n_known)],
                        *[pa.array(x, pa.float64()) for x in (base, lattice)],
                    ],
                    schema.fieldNames(),
                )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, schema)
    rare = lexicon.select("word", F.col("n_train").alias("c"), F.col("lattice").alias("lattice_of_word"))
    joined = rows.join(rare, "word", "left")
    c, k = F.coalesce("c", F.lit(0)), F.col("times")
    summed = joined.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(k == 0, 1)).alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, k).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + k * F.log10((c + 1) / F.lit(denominator))).alias("base"),
        F.sum(F.col("lattice") + k * F.coalesce("lattice_of_word", F.lit(0.0))).alias("lattice"),
    )
    each = lambda x: F.col(x) / F.col("copies")
    return (
        summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            each("n_tokens").cast("long").alias("n_tokens"),
            each("n_known").cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            each("base").alias("base_score"),
            each("lattice").alias("score"),
        )
    )
