"""Incremental intake with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import upserted
from ..operators.dedup import best_per_key
from .commits import CommitLog


def events(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """A stream over the files of a folder; each file is read once for a checkpoint."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def timed(df: DataFrame, at: str) -> DataFrame:
    """The event time as a timestamp with the session's zone, as watermarks want it."""
    return df.withColumn(at, F.col(at).cast("timestamp"))


def deduplicated(stream: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """The first arrival of each key within the watermark."""
    return timed(stream, at).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, at: str, key: str, value: str, size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """start, end, key, n, total of tumbling or sliding windows."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    stream = timed(stream, at)
    g = (stream.withWatermark(at, late) if stream.isStreaming else stream).groupBy(w.alias("w"), key)
    return g.agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def sessions(stream: DataFrame, at: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    """start, end, key, n of sessions that end after a gap."""
    stream = timed(stream, at)
    g = (stream.withWatermark(at, late) if stream.isStreaming else stream).groupBy(F.session_window(at, gap).alias("w"), key)
    return g.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there, batch by batch, and stop.  The sink must be idempotent by batch id."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()


def upsert_into(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the latest row of each key as versioned tables: path/v=N is the state after batch N.

    It starts from the last committed version before its own, and commits after its files, so a failed batch leaves no gap.
    The whole table is written each time: for tables kept by period see ``restating``.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, path)
        rest = [c for c in batch.columns if c not in keys]
        fresh = best_per_key(batch, keys, [F.struct(*rest)])  # of a key's rows in one batch, the same one each time
        before = [n for n in log.numbers() if n < number]
        if before:
            fresh = upserted(spark.read.parquet(f"{path}/v={before[-1]}"), fresh, keys)
        fresh.write.mode("overwrite").parquet(f"{path}/v={number}")
        log.write(number, {"version": number})

    return sink
