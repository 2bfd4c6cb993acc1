"""Claims in two times as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import claims
from .registry import query, table

_LOG = """log AS (SELECT concat(user_id, '/', event_id % 7) AS claim, event_id AS seq, ts AS recorded_at, CAST(ts AS DATE) - CAST(event_id % 5 AS INT) AS valid_from,
  CASE WHEN event_id % 3 > 0 THEN CAST(ts AS DATE) + CAST(event_id % 11 AS INT) END AS valid_to, value, event_type = 'error' AS retracted FROM events)"""
_LAST = "row_number() OVER (PARTITION BY {by}claim ORDER BY recorded_at DESC, seq DESC) = 1"


def _log(spark, sf_dir):
    """The events as a log of claims, of which errors are retractions."""
    i, day = F.col("event_id"), F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), (i % 7).cast("string")).alias("claim"),
        i.alias("seq"),
        F.col("ts").alias("recorded_at"),
        F.date_sub(day, (i % 5).cast("int")).alias("valid_from"),
        F.when(i % 3 > 0, F.date_add(day, (i % 11).cast("int"))).alias("valid_to"),
        "value",
        (F.col("event_type") == "error").alias("retracted"),
    )


@query(f"""WITH {_LOG}, days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
known AS (SELECT day, log.* FROM days JOIN log ON CAST(recorded_at AS DATE) <= day QUALIFY {_LAST.format(by="day, ")})
SELECT CAST(day AS VARCHAR) AS day, claim, value FROM known WHERE NOT retracted AND valid_from <= day AND (valid_to IS NULL OR day < valid_to)""")
def claims_on_days(spark, sf_dir):
    """For each day what was known at its end and held on it."""
    found = claims.on_days(_log(spark, sf_dir), table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")))
    return found.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""WITH {_LOG}, a AS (SELECT * FROM log WHERE recorded_at <= TIMESTAMP '2024-01-10' QUALIFY {_LAST.format(by="")}),
b AS (SELECT * FROM log WHERE recorded_at <= TIMESTAMP '2024-01-20' QUALIFY {_LAST.format(by="")}),
x AS (SELECT * FROM a WHERE NOT retracted), y AS (SELECT * FROM b WHERE NOT retracted)
SELECT coalesce(x.claim, y.claim) AS claim, CASE WHEN x.claim IS NULL THEN 'added' WHEN y.claim IS NULL THEN 'dropped' ELSE 'changed' END AS change, x.value AS before, y.value AS after
FROM x FULL JOIN y ON x.claim = y.claim WHERE x.claim IS NULL OR y.claim IS NULL OR x.value <> y.value OR x.valid_from <> y.valid_from OR x.valid_to IS DISTINCT FROM y.valid_to""")
def claims_changed(spark, sf_dir):
    """What is known of claims on the 20th and wasn't on the 10th, and the reverse."""
    moment = lambda d: F.lit(d).cast("timestamp_ntz")
    return claims.changes_between(_log(spark, sf_dir), moment("2024-01-10"), moment("2024-01-20"))
