"""Streams and organisation changes as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import changes
from ..sources import interim
from ..streaming import arrivals, incremental, restating
from .registry import query, table

_KINDS = [*sorted(k for level in changes.SEVERITY.values() for k in level), "PICNIC"]
_STATES = [*changes.STATES, "LOST"]
_EVIDENCE = [*changes.EVIDENCE, "RUMOUR"]


def _pick(values, at):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))


def _change_events(e):
    """The events table as organisation changes, some of which break a rule."""
    i, u, day = F.col("event_id"), F.col("user_id"), F.to_date("ts")
    entity = lambda k: F.concat(F.lit("E"), (u + k).cast("string"))
    some = lambda when, *items: F.when(when, F.array(*items)).otherwise(F.array().cast("array<string>"))
    return e.select(
        "event_id",
        F.concat(F.lit("C"), i.cast("string")).alias("change_event_id"),
        F.when(u % 41 != 0, entity(0)).alias("affected_entity_id"),
        _pick(_KINDS, i).alias("event_type"),
        _pick(_STATES, u).alias("status"),
        _pick(changes.CERTIFICATION, F.floor(i / 39)).alias("certification_state"),
        F.col("value").cast("int").cast("string").alias("percent"),
        (F.floor("value") / 50).alias("confidence"),
        F.array(_pick(_EVIDENCE, F.floor(i / 7)), _pick(changes.SUCCESSION_EVIDENCE, u)).alias("both"),
        some(i % 5 == 0, entity(1), entity(1 + F.floor(i / 5) % 3)).alias("predecessors"),
        some(i % 4 == 0, entity(2)).alias("successors"),
        F.when(i % 6 > 0, F.date_format(day, "yyyy-MM-dd")).alias("effective_date"),
        F.when(i % 2 > 0, F.date_format(F.date_add(day, (i % 8 - 6).cast("int")), "yyyy-MM-dd")).alias("instrument_date"),
        F.when(i % 97 == 0, "soon").alias("announcement_date"),
        some(i % 11 == 0, F.lit("k")).alias("contracts"),
        some(i % 13 == 0, F.lit("k")).alias("assets"),
        some(i % 17 == 0, F.lit("k")).alias("personnel"),
    ).withColumn("evidence", F.when(i % 3 > 0, F.col("both")).otherwise(F.slice("both", 1, 1)))


def _quoted(values):
    return ", ".join(f"'{v}'" for v in values)


def _sql_list(values):
    return f"[{_quoted(values)}]"


def _sql_case(column, table_, other):
    return "CASE " + " ".join(f"WHEN {column} IN ({_quoted(kinds)}) THEN '{level}'" for level, kinds in table_.items()) + f" ELSE '{other}' END"


_CHANGES_SQL = f"""
WITH raw AS (
  SELECT event_id AS i, user_id AS u, CAST(ts AS DATE) AS day, value FROM events
), e AS (
  SELECT i AS event_id, CASE WHEN u % 41 <> 0 THEN 'E' || u END AS entity,
    {_sql_list(_KINDS)}[CAST(i % {len(_KINDS)} + 1 AS INT)] AS kind,
    {_sql_list(_STATES)}[CAST(u % {len(_STATES)} + 1 AS INT)] AS status,
    floor(value) / 50 AS confidence,
    CASE WHEN i % 3 > 0 THEN [{_sql_list(_EVIDENCE)}[CAST(i // 7 % {len(_EVIDENCE)} + 1 AS INT)],
      {_sql_list(changes.SUCCESSION_EVIDENCE)}[CAST(u % {len(changes.SUCCESSION_EVIDENCE)} + 1 AS INT)]]
      ELSE [{_sql_list(_EVIDENCE)}[CAST(i // 7 % {len(_EVIDENCE)} + 1 AS INT)]] END AS evidence,
    CASE WHEN i % 5 = 0 THEN ['E' || (u + 1), 'E' || (u + 1 + i // 5 % 3)] ELSE [] END AS before,
    CASE WHEN i % 4 = 0 THEN ['E' || (u + 2)] ELSE [] END AS after,
    CASE WHEN i % 6 > 0 THEN day END AS effective,
    CASE WHEN i % 2 > 0 THEN day + CAST(i % 8 - 6 AS INT) END AS instrument,
    i % 97 = 0 AS unread, i % 11 = 0 AS contracts, i % 13 = 0 AS assets, i % 17 = 0 AS personnel
  FROM raw
), f AS (
  SELECT *, len(before) > 0 OR len(after) > 0 AS ends,
    CASE WHEN entity IS NULL THEN 'identity missing'
      WHEN kind = 'PICNIC' THEN 'unsupported event_type'
      WHEN status = 'LOST' THEN 'unsupported status'
      WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence outside 0 to 1'
      WHEN len(before) <> len(list_distinct(before)) THEN 'entity named twice'
      WHEN unread THEN 'unreadable date'
      WHEN effective < instrument THEN 'effective before instrument'
      WHEN list_contains(evidence, 'RUMOUR') THEN 'evidence missing or unknown'
      WHEN (len(before) > 0 OR len(after) > 0) AND NOT list_has_any(evidence, {_sql_list(changes.SUCCESSION_EVIDENCE)}) THEN 'succession without authority'
      WHEN list_contains(evidence, 'LEGISLATIVE_PROPOSAL') AND NOT list_has_any(evidence, {_sql_list(changes.OPERATIONAL_EVIDENCE)})
        AND (effective IS NOT NULL OR status IN ({_quoted(changes.TERMINAL)})) THEN 'proposal can''t bind'
      WHEN kind = 'RENAMING' AND (len(before) > 0 OR len(after) > 0) THEN 'renaming isn''t succession'
    END AS fault,
    {_sql_case("kind", changes.SEVERITY, "S0")} AS severity,
    effective IS NOT NULL AND list_has_any(evidence, CASE WHEN kind IN ({_quoted(changes.OPERATIONAL)}) AND kind NOT IN ({_quoted(changes.STRUCTURAL)})
      THEN {_sql_list(changes.OPERATIONAL_EVIDENCE)} ELSE {_sql_list(changes.LEGAL_EVIDENCE)} END) AS binding,
    CASE WHEN len(before) = 0 OR len(after) = 0 THEN 'UNRESOLVED'
      ELSE (CASE WHEN len(before) = 1 THEN '1' ELSE 'N' END) || ':' || (CASE WHEN len(after) = 1 THEN '1' ELSE 'N' END) END AS cardinality,
    CASE WHEN kind IN ({_quoted([*changes.SEVERITY["S4"], *changes.WIDE])}) THEN {_sql_list(changes.ALL_SCOPES)}
      ELSE list_sort(list_distinct(list_concat({_sql_list(changes.ALWAYS)},
        CASE kind {" ".join(f"WHEN '{k}' THEN {_sql_list(v)}" for k, v in changes.SCOPES.items())} ELSE [] END,
        CASE WHEN contracts THEN {_sql_list(changes.CARRIED["contracts"])} ELSE [] END,
        CASE WHEN assets THEN {_sql_list(changes.CARRIED["assets"])} ELSE [] END,
        CASE WHEN personnel THEN {_sql_list(changes.CARRIED["personnel"])} ELSE [] END))) END AS scopes
  FROM e
), g AS (
  SELECT *, list_filter([CASE WHEN severity IN ('S3', 'S4') THEN 'MAJOR_OR_STRUCTURAL_CHANGE' END,
    CASE WHEN list_has_any(scopes, {_sql_list(changes.MONEY_SCOPES)}) THEN 'MONEY_OR_CONTROL_EDGE_RECOMPUTE' END,
    CASE WHEN kind = 'PARENT_CHANGE' THEN 'ENTITY_HIERARCHY_RECOMPUTE' END,
    CASE WHEN ends THEN 'SUCCESSION_RECOMPUTE' END], lambda x: x IS NOT NULL) AS alarms,
    list_filter([CASE WHEN cardinality = 'UNRESOLVED' AND kind IN ({_quoted(changes.STRUCTURAL)}) THEN 'SUCCESSION_CARDINALITY_UNRESOLVED' END,
    CASE WHEN NOT binding THEN 'NONBINDING_OR_NOT_YET_EFFECTIVE' END], lambda x: x IS NOT NULL) AS rest FROM f
)
SELECT event_id, fault, CASE WHEN fault IS NULL THEN severity END AS severity, CASE WHEN fault IS NULL THEN binding END AS binding,
  CASE WHEN fault IS NULL THEN CASE WHEN NOT binding AND status IN ({_quoted(changes.TERMINAL)}) THEN 'UNKNOWN' ELSE status END END AS timeline_state,
  CASE WHEN fault IS NULL THEN cardinality END AS cardinality, CASE WHEN fault IS NULL THEN array_to_string(scopes, ',') END AS scopes,
  CASE WHEN fault IS NULL THEN array_to_string(list_concat(alarms, rest), ',') END AS reasons, CASE WHEN fault IS NULL THEN len(alarms) > 0 END AS alert
FROM g
"""


@query(_CHANGES_SQL)
def change_evaluations(spark, sf_dir):
    """Every event as an organisation change: the rule that it breaks, or what it means."""
    found = changes.evaluated(_change_events(table(spark, sf_dir, "events")))
    return found.select(
        "event_id", "fault", "severity", "binding", "timeline_state", "cardinality",
        F.array_join("scopes", ",").alias("scopes"), F.array_join("reasons", ",").alias("reasons"), "alert",
    )


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS k FROM events)
SELECT concat(user_id, '/', event_type, '/', CAST(ts AS DATE)) AS change_event_id, event_id,
  CASE WHEN k = 1 THEN 'row' ELSE 'error' END AS outcome, CASE WHEN k > 1 THEN 'duplicate id' END AS error FROM r
""")
def change_arrivals(spark, sf_dir):
    """The events as a stream: of an id (user, kind, day) the first arrival is a row, each further one an error."""
    stream = incremental.events(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)  # a pattern: one file is no folder
    day = F.date_format("ts", "yyyy-MM-dd")
    marked = stream.select(F.concat_ws("/", "user_id", "event_type", day).alias("change_event_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"))
    folder = interim.new_folder(spark, "arrivals")
    schema = arrivals.evaluate(marked, "change_event_id", ["ts", "event_id"], folder)
    rows, errors = arrivals.outcomes(spark, folder, schema)
    rows = rows.select("change_event_id", "event_id", F.lit("row").alias("outcome"), F.lit(None).cast("string").alias("error"))
    return rows.unionByName(errors.select("change_event_id", "event_id", F.lit("error").alias("outcome"), "error"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS period, user_id, max_by(event_id, struct_pack(t := ts, i := event_id)) AS event_id,
  max_by(value, struct_pack(t := ts, i := event_id)) AS value FROM events GROUP BY 1, 2
""")
def history_restated(spark, sf_dir):
    """Each day's last value of a user, from a stream whose later files correct days that earlier ones wrote."""
    rows = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("period"), "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    folder = interim.new_folder(spark, "history")
    rows.repartition(4, F.xxhash64("event_id")).write.parquet(f"{folder}/in")  # every file holds rows of every day
    stream = incremental.events(spark, f"{folder}/in", rows.schema, files_per_trigger=1)
    incremental.run_available(stream, f"{folder}/state", restating.restate_into(f"{folder}/out", ["period", "user_id"], "period", ["ts", "event_id"]))
    return restating.restated(spark, f"{folder}/out", rows.schema).select("period", "user_id", "event_id", "value")
