"""Intermediate tables of the library in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; on a local master one of our own where that is unset, elsewhere that raises."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="ledgerline-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return "file://" + _own[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/ledgerline-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def settled(df: DataFrame, name: str = "interim") -> DataFrame:
    """df as read from a table written once: a lost executor costs a re-read, not the work before."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Shuffle files of what is written down by now go when the driver finds their plans gone: it is asked to look."""
    spark.sparkContext._jvm.System.gc()


@atexit.register
def _clear() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:
            try:
                where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            except Exception:  # the session is gone: whoever owns the shared folder clears it
                pass
    _written.clear()
