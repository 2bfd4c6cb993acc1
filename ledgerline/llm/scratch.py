"""Intermediate tables in the folder that the driver and all executors share.

Lineage is cut by writing a Parquet table and reading it back, so a lost
executor costs a re-read, never the work that came before.  The folder is the
one named in ``spark.checkpoint.dir``; only on a local master (tests, a laptop)
a folder of our own is made where that is unset, elsewhere that raises.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="ledgerline-"))
    return "file://" + _own[0]


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return it as read from the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerline/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files behind a table made here that nothing needs any more."""
    files = df.inputFiles()
    for entry in list(_made):
        if files and entry[1].split("://")[-1] in files[0]:
            _delete(*entry)
            _made.remove(entry)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone: whoever owns the shared folder clears it
        pass


@atexit.register
def _clear() -> None:
    for entry in _made:
        if entry[0].sparkContext._jsc is not None:
            _delete(*entry)
    _made.clear()
