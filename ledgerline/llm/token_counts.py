"""Token counts answered from an exact length histogram.

``token_lengths`` encodes each whole text and keeps its length only;
``length_histogram`` counts documents by length; ``limits_report`` turns the
histogram into running and suffix sums, from which totals, quantiles and
truncated totals follow for every context limit: what a limit not in the table
would answer is that of the next lower row (see ``answer``).

The histogram has a row for each distinct length.  Its sums run over blocks of
lengths first and over the lengths of a block then, so no task holds more than
a block.  The sums over blocks are one task: its rows grow with the longest
document (one for each 1,024 tokens), not with their number.  Defined cases:
null text is empty, with length 0; rows that repeat count each; lengths that
tie share a row; very long texts are encoded whole, in slices of bounded size; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_rows import slices
from .scratch import materialise
from .tokens import SpacedCounts, coder

BLOCK = 1024


def token_lengths(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """n_tokens of each document."""

    def run(batches):
        own = coder(SpacedCounts, tokenizer_path)
        for batch in slices(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(own.counts(batch.column(0)), pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(run, T.StructType([T.StructField("n_tokens", T.LongType())]))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: a row for each distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits_report(histogram: DataFrame) -> DataFrame:
    """For each length L of the histogram as context limit.

    n_docs of that length; docs_within and tokens_within (length <= L); docs_over and
    tokens_over (length > L); truncated_total, the tokens left if every document is cut
    to L; total_docs, total_tokens; quantile, the share of documents within.
    """
    # read twice below: the texts must not be encoded twice
    histogram = materialise(histogram, "length-histogram")
    h = histogram.withColumns({"block": F.floor(F.col("n_tokens") / BLOCK), "tokens": F.col("n_tokens") * F.col("n_docs")})
    # a row for each block of lengths: as many as the longest document has times 1/BLOCK
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    out = h.join(blocks, "block").withColumns(
        {
            "docs_within": F.col("d0") + F.sum("n_docs").over(inside),
            "tokens_within": F.col("t0") + F.sum("tokens").over(inside),
        }
    )
    out = out.withColumns(
        {
            "docs_over": F.col("total_docs") - F.col("docs_within"),
            "tokens_over": F.col("total_tokens") - F.col("tokens_within"),
        }
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_within",
        "tokens_within",
        "docs_over",
        "tokens_over",
        (F.col("tokens_within") + F.col("n_tokens") * F.col("docs_over")).alias("truncated_total"),
        "total_docs",
        "total_tokens",
        (F.col("docs_within") / F.col("total_docs")).alias("quantile"),
    )


def answer(report: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: docs_within, tokens_within, docs_over, truncated_total."""
    low = report.filter(F.col("n_tokens") <= limit).agg(F.max_by(F.struct("*"), "n_tokens").alias("r"))
    total = report.agg(F.max("total_docs").alias("all_docs"))
    both = low.join(total, F.lit(True))  # a row each
    within, over = F.coalesce("r.docs_within", F.lit(0)), F.coalesce("r.docs_over", "all_docs")
    tokens = F.coalesce("r.tokens_within", F.lit(0))
    return both.select(
        F.lit(limit).alias("context_limit"),
        within.alias("docs_within"),
        tokens.alias("tokens_within"),
        over.alias("docs_over"),
        (tokens + F.lit(limit) * over).alias("truncated_total"),
    )
