"""Quality rules with risk-controlled cutoffs (DataFrame operations only).

``rule_metrics`` measures each whole text.  ``certified_cutoffs`` looks at the
documents labelled good, in each stratum (language): they are holdouts, for the
cutoffs come from fixed ``LEVELS``, each a cutoff for every rule, from loose to
strict.  A level is tested by the exact binomial test of "the rules together
reject more than ``max_loss`` of the good documents".  Levels are tested in their
order and the first that fails ends the chain, so a chain needs no correction
within itself; over the strata the error is split evenly (Bonferroni).  With
probability 1 - delta no stratum loses more than ``max_loss``.  The strictest
certified level applies.  With no loss at all a level needs
log(delta / strata) / log(1 - max_loss) good labels, 144 for four strata; a
stratum with fewer gets no cutoff and loses nothing.

Defined cases: null or empty text has no words and fails the base rule; null
language is a stratum of its own; rows that repeat are rows of their own; ties
with a cutoff are kept; an empty table gives no rows; a repeated label row
counts once; a document labelled both ways is not good; texts of any length
are measured whole, one at a time; further columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise

MAX_LOSS, DELTA = 0.03, 0.05
#: Rule -> metric as SQL: a document is rejected above the cutoff.
RULES: dict[str, str] = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "lines": "n_dup_lines / greatest(n_lines, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}
#: Cutoffs of the rules, from loose to strict.
LEVELS: list[tuple[float, float, float]] = [
    (0.5, 0.9, 50.0),
    (0.4, 0.8, 30.0),
    (0.3, 0.7, 20.0),
    (0.2, 0.6, 15.0),
    (0.15, 0.5, 13.0),
    (0.1, 0.4, 12.0),
    (0.05, 0.3, 10.0),
]
_SPACE = " \t\n\u000b\f\r"


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the column words.

    Windows are first compared by a 64-bit hash: if all differ, none repeats.
    Only texts where some hashes agree go through the exact step: windows
    sorted with their place, equal neighbours marked, their words counted once.
    """
    hashes = F.expr(
        "CASE WHEN size(words) > 5 THEN transform(sequence(0, size(words) - 5), i -> xxhash64("
        "words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) END"
    )
    exact = F.expr(
        "CASE WHEN size(hashes) > size(array_distinct(hashes)) THEN sort_array(transform(sequence(0, size(words) - 5),"
        " i -> named_struct('w', array_join(slice(words, i + 1, 5), ' '), 'i', i))) END"
    )
    places = F.expr(
        "array_sort(transform(filter(transform(windows, (x, j) -> named_struct('i', x.i, 'twice',"
        " x.w = get(windows, j - 1).w OR x.w = get(windows, j + 1).w)), y -> y.twice), y -> y.i))"
    )
    covered = F.expr(
        "coalesce(aggregate(transform(places, (p, j) -> least(5L, coalesce(get(places, j + 1), p + 5) - p)),"
        " 0L, (a, x) -> a + x), 0L)"
    )
    return (
        docs.withColumn("hashes", hashes)
        .withColumn("windows", exact)
        .withColumn("places", places)
        .withColumn("n_repeat_words", covered)
        .drop("hashes", "windows", "places")
    )


def rule_metrics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed to docs."""
    text = F.coalesce("text", F.lit(""))
    words: Column = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    bare = F.translate(text, _SPACE, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _SPACE, "") != "")
    found = docs.withColumns(
        {
            "words": words,
            "lines": lines,
            "word_chars": F.length(bare).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        }
    )
    found = _repeat_words(found).withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed).drop("words", "lines")


def _binomial_tail(k: str, n: str, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p, term by term from log P(X = 0)."""
    return F.expr(
        f"aggregate(sequence(0L, {k}), named_struct('t', {n} * ln(1 - {p}D), 's', 0D),"
        f" (a, i) -> named_struct('t', a.t + ln(greatest({n} - i, 1)) - ln(i + 1) + ln({p}D / (1 - {p}D)),"
        " 's', a.s + exp(a.t)), a -> a.s)"
    )


def certified_cutoffs(
    metrics: DataFrame, labels: DataFrame, stratum: str = "lang", max_loss: float = MAX_LOSS, delta: float = DELTA
) -> DataFrame:
    """From written ``rule_metrics``, one row per stratum that has good labels: stratum, n_held, level (0: none), and the cutoff of each rule (null: none)."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    held = metrics.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    above = lambda cuts: F.expr(" OR ".join(f"{m} > {c}D" for m, c in zip(RULES.values(), cuts, strict=True)))
    counts = held.groupBy(stratum).agg(
        F.count("*").alias("n"), *[F.count(F.when(above(cuts), 1)).alias(f"lost_{i}") for i, cuts in enumerate(LEVELS)]
    )
    counts = counts.withColumn("strata", F.count("*").over(Window.partitionBy(F.lit(0))))  # a row per stratum
    passed = []
    for i in range(len(LEVELS)):
        few = F.col(f"lost_{i}") < max_loss * F.col("n")
        # beyond the mean the tail is over a half, so the sum is not needed there
        tail = F.when(few, _binomial_tail(f"lost_{i}", "n", max_loss))
        passed.append(F.coalesce(tail <= F.lit(delta) / F.col("strata"), F.lit(False)))
    fails = F.array_position(F.array(*passed, F.lit(False)), False)  # where the chain ends
    found = counts.select(F.col(stratum).alias("stratum"), F.col("n").alias("n_held"), (fails - 1).cast("int").alias("level"))
    cuts = [
        F.get(F.array(*[F.lit(c[k]) for c in LEVELS]), F.col("level") - 1).alias(f"cut_{rule}") for k, rule in enumerate(RULES)
    ]
    return found.select("*", *cuts)


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, the stratum, the metrics, base_failed, failed_rules (array) and kept; other columns are ignored."""
    metrics = materialise(rule_metrics(docs.select("doc_id", "text", stratum)).drop("text"), "rule-metrics")
    cuts = certified_cutoffs(metrics, labels, stratum)
    joined = metrics.join(cuts, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
    failed = F.filter(
        F.array(
            *[
                F.when(F.expr(metric) > F.col(f"cut_{rule}"), F.lit(rule))
                for rule, metric in RULES.items()
            ]
        ),
        lambda r: r.isNotNull(),
    )
    return joined.withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )
