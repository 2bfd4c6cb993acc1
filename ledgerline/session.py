"""SparkSession with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "ledgerline") -> SparkSession:
    """UTC, adaptive execution with skew joins, ANSI on (casts of dirty text are tried, never forced)."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key in ("enabled", "coalescePartitions.enabled", "skewJoin.enabled"):
        builder = builder.config(f"spark.sql.adaptive.{key}", "true")
    return builder.config("spark.ui.enabled", "false").getOrCreate()
