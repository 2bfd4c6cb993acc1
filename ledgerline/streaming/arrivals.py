"""Arrival order in a stream: the first arrival of an id counts, each further one is an error, across batches and restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import commits, incremental

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Columns beside those of the stream: the key of an id that is new, and that it is.
NEW_KEY, NEW = "_new_key", "_new"


def with_new_keys(stream: DataFrame, key: str) -> DataFrame:
    """The stream, and beside its rows one more for each key that no batch before has had.

    Both come from the same batch of the same source.  The state is the keys seen, in Spark's own deduplication: no row waits in it.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = stream.withColumns({NEW_KEY: F.col(key), NEW: F.lit(False)})
    fresh = stream.select(F.col(key).alias(NEW_KEY)).dropDuplicates([NEW_KEY]).withColumn(NEW, F.lit(True))
    return rows.unionByName(fresh, allowMissingColumns=True)


def judged(batch: DataFrame, order: list[str]) -> DataFrame:
    """The rows of a batch with outcome: ``row`` for the first of each new key by ``order``, ``error`` for all others.

    The row that says a key is new sorts before the key's own rows, so the first of these has the second place behind it.  Sorting spills:
    a key with very many rows needs no more memory than others.
    """
    by = Window.partitionBy(NEW_KEY).orderBy(F.desc(NEW), *[F.col(c).asc_nulls_last() for c in order])
    placed = batch.withColumn("_place", F.row_number().over(by)).withColumn("_first", F.first(NEW).over(by))
    outcome = F.when(F.col("_first") & (F.col("_place") == 2), "row").otherwise("error")
    return placed.filter(~F.col(NEW)).withColumn("outcome", outcome).drop(NEW_KEY, NEW, "_place", "_first")


def evaluate(stream: DataFrame, key: str, order: list[str], path: str) -> T.StructType:
    """Run what is there: first arrivals and errors under ``path``/out, each batch once.  Returns the schema of both.

    Within a batch, arrival is by ``order``.  Null keys are a key like others.
    """
    write = commits.exactly_once(f"{path}/out", "outcome")
    incremental.run_available(with_new_keys(stream, key), f"{path}/state", lambda batch, number: write(judged(batch, order), number))
    return T.StructType([*stream.schema.fields, T.StructField("outcome", T.StringType())])


def outcomes(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of all committed batches; an error says which id came again."""
    rows = commits.committed(spark, f"{path}/out", schema, "outcome", "row")
    errors = commits.committed(spark, f"{path}/out", schema, "outcome", "error")
    return rows, errors.withColumn("error", F.lit("duplicate id"))
