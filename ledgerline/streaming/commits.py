"""A commit log for sinks: what a reader sees is what whole batches left behind.

A batch writes its files into a folder of its number first and its commit after
that, in one small file; readers take only folders that a commit names.  A batch
that fails half-way has no commit, and its next attempt writes the same folder
again: nothing is lost or doubled, whatever is run twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class CommitLog:
    """The commits under ``path``/_commits: number -> a small JSON document."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/{name}")
        self.fs = self._at("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        folder = self._at("x").getParent()
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._at(str(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, number: int, said: dict) -> None:
        """Written beside and moved into place, so a commit is there whole or not at all."""
        beside = self._at(f".{number}.tmp")
        out = self.fs.create(beside, True)
        try:
            out.write(bytearray(json.dumps(said, sort_keys=True).encode()))
        finally:
            out.close()
        place = self._at(str(number))
        if self.fs.exists(place):
            self.fs.delete(place, False)
        if not self.fs.rename(beside, place):
            raise OSError(f"commit {number} can't be moved into place")


def exactly_once(path: str, split: str | None = None):
    """A sink that appends each batch once; with ``split``, by the values of that column (``path``/batch=N/split=value)."""

    def sink(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite")
        if split:
            writer = writer.partitionBy(split)
        writer.parquet(f"{path}/batch={number}")
        CommitLog(batch.sparkSession, path).write(number, {"batch": number})

    return sink


def committed(spark: SparkSession, path: str, schema: T.StructType, split: str | None = None, value: str | None = None) -> DataFrame:
    """What committed batches have written, with ``split`` = ``value`` only if they are given."""
    log = CommitLog(spark, path)
    jvm, found = spark.sparkContext._jvm, []
    for number in log.numbers():
        folder = f"{path}/batch={number}" + (f"/{split}={value}" if split and value else "")
        if log.fs.exists(jvm.org.apache.hadoop.fs.Path(folder)):
            found.append(folder)
    if split and value:
        schema = T.StructType([f for f in schema.fields if f.name != split])
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.parquet(*found) if not split or value else reader.option("basePath", path).parquet(*found).select(*schema.fieldNames())
