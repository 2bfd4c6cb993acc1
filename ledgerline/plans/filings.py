"""Filings: which of them count, what replaced the others, and what each is left out for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import graph


def replacements(filings: DataFrame, filing: str, replaces: str, order: list[str]) -> DataFrame:
    """filing, last, hops, cycle, rivals: the last filing of the chain that replaces each one.

    Of several filings that replace the same one the last by order goes on, and rivals counts them.  A filing that
    nothing replaces is its own last one (hops 0); one whose chain goes in a circle has no last.
    """
    rows = filings.filter(F.col(replaces).isNotNull()).groupBy(F.col(replaces).alias("node"))
    after = rows.agg(F.max_by(filing, F.struct(*order, filing)).alias("next"), F.count_distinct(filing).alias("rivals"))
    nodes = filings.select(F.col(filing).alias("node")).distinct().join(after, "node", "left")
    ends = graph.chains(nodes.select("node", "next")).join(nodes.select("node", F.coalesce("rivals", F.lit(0)).alias("rivals")), "node")
    return ends.withColumnRenamed("node", filing)


def denominator(filings: DataFrame, filing: str, replaces: str, at: str, reported: str, required: list[str], in_scope: Column) -> DataFrame:
    """filings with state (retained or excluded), reason, last and hops.

    Reasons, the first that holds: MISSING_FIELD, FILED_BEFORE_PERIOD, DUPLICATE_FILING, FORM_TYPE_OUT_OF_SCOPE,
    REPLACEMENT_CYCLE, REPLACEMENT_CONFLICT (several filings replace it), SUPERSEDED.
    Every row is in one of both states, so the counts close.
    """
    blank = F.lit(False)
    for c in [*required, filing, at]:
        blank = blank | (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
    known = filings.groupBy(F.col(filing).alias("_same")).agg(F.count("*").alias("_n"))
    chain = replacements(filings, filing, replaces, [at])
    df = filings.join(known, F.col(filing) == F.col("_same"), "left").drop("_same").join(chain, filing, "left")
    reason = (
        F.when(blank, "MISSING_FIELD")
        .when(F.col(at) < F.col(reported), "FILED_BEFORE_PERIOD")
        .when(F.col("_n") > 1, "DUPLICATE_FILING")
        .when(~F.coalesce(in_scope, F.lit(False)), "FORM_TYPE_OUT_OF_SCOPE")
        .when(F.col("cycle").isNotNull(), "REPLACEMENT_CYCLE")
        .when(F.col("rivals") > 1, "REPLACEMENT_CONFLICT")
        .when(F.col("hops") > 0, "SUPERSEDED")
    )
    return df.withColumn("reason", reason).withColumn("state", F.when(reason.isNull(), "retained").otherwise("excluded")).drop("_n")


def placed(df: DataFrame, scope: list[str], at: str, filing: str) -> DataFrame:
    """Adds place: the retained filings of each scope in order of (at, filing)."""
    w = Window.partitionBy(*scope, "state").orderBy(at, filing)
    return df.withColumn("place", F.when(F.col("state") == "retained", F.row_number().over(w)))


def tally(df: DataFrame) -> DataFrame:
    """state, reason, filings: the counts, which add up to all rows."""
    return df.groupBy("state", "reason").agg(F.count("*").alias("filings"))
