"""Restatement of history: a stream of late corrections against a table kept by period.

The table is a manifest (period -> the batch that wrote its files last) over files
``path``/batch=N/period=P.  A batch reads the files of the periods that it touches,
lets the highest version of each key win, and writes those periods only; all others keep
their files.  The manifest goes into the commit log after the files, and a batch starts
from the last commit before its own number, so an attempt that failed or is run again
changes nothing.  Old files stay for readers of older commits until ``vacuum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import CommitLog


def _manifest(log: CommitLog, before: int | None = None) -> dict[str, int]:
    numbers = [n for n in log.numbers() if before is None or n < before]
    return log.read(numbers[-1])["periods"] if numbers else {}


def _files(spark: SparkSession, path: str, manifest: dict[str, int], schema: T.StructType, periods: list[str] | None = None) -> DataFrame:
    wanted = sorted(manifest.items()) if periods is None else [(p, manifest[p]) for p in periods if p in manifest]
    if not wanted:
        return spark.createDataFrame([], schema)
    found = [f"{path}/batch={n}/_period={p}" for p, n in wanted]
    return spark.read.schema(schema).parquet(*found)


def restate_into(path: str, keys: list[str], period: str, version: list[str]):
    """A sink: of each key (which includes or fixes its period) the row of the highest version stays.

    period: a column with a value for each period, such as 2024-03 or its first hour; there is a manifest entry for each.
    """
    path = path.rstrip("/")
    named = F.regexp_replace(F.coalesce(F.col(period).cast("string"), F.lit("none")), "[^A-Za-z0-9-]", "_")

    def sink(batch: DataFrame, number: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        log = CommitLog(spark, path)
        manifest = _manifest(log, number)
        touched = [r[0] for r in batch.select(named).distinct().collect()]  # periods, not rows
        if touched:
            both = batch.unionByName(_files(spark, path, manifest, schema, touched))
            rest = [c for c in batch.columns if c not in keys]
            # the highest version; of rows that tie in it, the same one each time
            tied = [c for c in rest if c not in version]
            newest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version, *tied)).alias("_row"))
            newest = newest.select(*keys, "_row.*").select(*batch.columns)
            # few files for a period; a hot one is split by adaptive execution
            newest.withColumn("_period", named).hint("rebalance", "_period").write.mode("overwrite").partitionBy("_period").parquet(f"{path}/batch={number}")
        log.write(number, {"periods": manifest | {p: number for p in touched}})

    return sink


def restated(spark: SparkSession, path: str, schema: T.StructType, at: int | None = None) -> DataFrame:
    """The table after the last commit, or after batch ``at``."""
    log = CommitLog(spark, path)
    return _files(spark, path.rstrip("/"), _manifest(log, None if at is None else at + 1), schema)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that the last commit doesn't name, and the commits before it; how many folders went."""
    path, log = path.rstrip("/"), CommitLog(spark, path)
    numbers = log.numbers()
    if not numbers:
        return 0
    live = {(str(n), p) for p, n in log.read(numbers[-1])["periods"].items()}
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = 0
    for number in numbers:
        folder = place(f"{path}/batch={number}")
        if log.fs.exists(folder):
            for s in log.fs.listStatus(folder):
                name = s.getPath().getName()
                if name.startswith("_period=") and (str(number), name[len("_period=") :]) not in live:
                    log.fs.delete(s.getPath(), True)
                    gone += 1
        if number != numbers[-1]:
            log.fs.delete(log._at(str(number)), False)
    return gone
