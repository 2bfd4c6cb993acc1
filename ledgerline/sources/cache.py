"""A read-through cache of query results as Parquet with a time to live."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .readers import exists

# Seconds that results of each cadence stay fresh.
CADENCE = {"daily": 86_400, "weekly": 604_800, "monthly": 2_592_000, "quarterly": 7_776_000, "yearly": 31_536_000, "annual": 31_536_000}
DEFAULT_CADENCE = "weekly"


def query_hash(query: dict) -> str:
    """The same for the same criteria in any order."""
    plain = {k: sorted(v) if isinstance(v, (list, set, tuple)) else v for k, v in query.items() if v not in (None, [], ())}
    return hashlib.sha256(json.dumps(plain, sort_keys=True, default=str).encode()).hexdigest()[:32]


def cached(spark: SparkSession, root: str, source: str, query: dict, cadence: str | None, fetch: Callable[[], DataFrame], now: float | None = None) -> DataFrame:
    """What was stored for the query, if it is fresh and whole; else what fetch gives, stored first.

    The folder's name holds the time, and Spark marks a finished write, so a broken write is a miss.
    Without a cadence, or with one that is not known, results stay fresh for a week.
    """
    now = time.time() if now is None else now
    fresh_for = CADENCE.get((cadence or "").strip().lower(), CADENCE[DEFAULT_CADENCE])
    base = f"{root}/{source}/{query_hash(query)}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(base)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    times = sorted((int(s.getPath().getName()) for s in fs.listStatus(where)), reverse=True) if fs.exists(where) else []
    for t in times:
        if now - t <= fresh_for and exists(spark, f"{base}/{t}/_SUCCESS"):
            return spark.read.parquet(f"{base}/{t}")
    df = fetch()
    df.write.mode("overwrite").parquet(f"{base}/{int(now)}")
    return spark.read.schema(df.schema).parquet(f"{base}/{int(now)}")
