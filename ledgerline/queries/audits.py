"""Audits of identities and links, and small products of whole tables, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits
from ..plans import political, products
from .registry import query, table


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem WHERE l_partkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def transfer_edges(spark, sf_dir):
    """Transfers whose recipient is itself a known payer."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return audits.transfers(lines, table(spark, sf_dir, "customer").filter("c_acctbal > 0"), "l_suppkey", "l_partkey", "c_custkey")


@query("""
WITH m AS (SELECT 'ENT_ORG_' || s_suppkey AS id, CAST(s_suppkey AS VARCHAR) AS tail, 0 AS place FROM supplier UNION ALL SELECT 'ENT_MUNI_' || n_nationkey, CAST(n_nationkey AS VARCHAR), 1 FROM nation),
i AS (SELECT tail, arg_max(id, (place, id)) AS master FROM m GROUP BY 1)
SELECT c_custkey, 'CLIENT_' || (c_custkey % 300) AS client, master FROM customer LEFT JOIN i ON tail = CAST(c_custkey % 300 AS VARCHAR)
""")
def id_tail_links(spark, sf_dir):
    """Ids of other systems joined to master ids by their tails; the later table of masters wins."""
    ids = lambda t, k, prefix, place: table(spark, sf_dir, t).select(F.concat(F.lit(prefix), F.col(k).cast("string")).alias("id"), F.lit(place).alias("place"))
    masters = ids("supplier", "s_suppkey", "ENT_ORG_", 0).unionByName(ids("nation", "n_nationkey", "ENT_MUNI_", 1))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("CLIENT_"), (F.col("c_custkey") % 300).cast("string")).alias("client"))
    return audits.by_tail(c, masters, "client", "id", "place")


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CASE WHEN o_orderkey % 11 > 0 THEN o_orderdate END AS day FROM orders), a AS (SELECT * FROM o WHERE o_orderstatus = 'F'),
d AS (SELECT e.o_orderkey, CAST(min(floor(epoch(e.day - a.day) / 86400)) AS BIGINT) AS days FROM o e JOIN a ON e.o_custkey = a.o_custkey AND a.day <= e.day WHERE e.o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT o.o_orderkey, days, CASE WHEN days <= 180 THEN 'exact_normalized_name+temporal' ELSE 'exact_normalized_name' END AS method, CAST(CASE WHEN days <= 180 THEN 0.90 ELSE 0.72 END AS DOUBLE) AS confidence
FROM o LEFT JOIN d ON o.o_orderkey = d.o_orderkey WHERE o_orderpriority = '1-URGENT' AND o_custkey IN (SELECT o_custkey FROM a)
""")
def activity_before(spark, sf_dir):
    """The last activity before each event, of half a year; events without one or without a date stay at a lower confidence."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate")))
    events = o.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey", "day")
    active = o.filter("o_orderstatus = 'F'").select("o_custkey", F.col("day").alias("active"))
    return audits.preceded(events, active, ["o_custkey"], "day", "active", 180).select("o_orderkey", "days", "method", "confidence")


@query("""
WITH n AS (SELECT concat('ENT_', c_custkey) AS entity, c_nationkey * 100 + c_custkey % 100 AS name FROM customer),
e AS (SELECT o_orderkey AS event, o_custkey % 4000 AS name, CASE WHEN o_orderkey % 11 > 0 THEN o_orderdate END AS day FROM orders WHERE o_orderpriority = '1-URGENT'),
a AS (SELECT o_custkey % 2500 AS name, o_orderdate AS day FROM orders WHERE o_orderstatus = 'F'),
d AS (SELECT event, CAST(min(floor(epoch(e.day - a.day) / 86400)) AS BIGINT) AS days FROM e JOIN a ON e.name = a.name AND a.day <= e.day GROUP BY 1)
SELECT entity, e.event, days, CASE WHEN days <= 180 THEN 'exact_normalized_name+temporal' ELSE 'exact_normalized_name' END AS method, CAST(CASE WHEN days <= 180 THEN 0.90 ELSE 0.72 END AS DOUBLE) AS confidence,
  concat('event:', e.event) AS evidence FROM e JOIN n ON n.name = e.name LEFT JOIN d ON d.event = e.event
""")
def entity_activity(spark, sf_dir):
    """Events of entities by name with the last activity before them; entities without any activity keep theirs at the lower confidence."""
    c = table(spark, sf_dir, "customer")
    names = c.select(F.concat(F.lit("ENT_"), F.col("c_custkey").cast("string")).alias("entity"), (F.col("c_nationkey") * 100 + F.col("c_custkey") % 100).alias("name"))
    o = table(spark, sf_dir, "orders")
    day = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate"))
    events = o.filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("event"), (F.col("o_custkey") % 4000).alias("name"), day.alias("day"))
    active = o.filter("o_orderstatus = 'F'").select((F.col("o_custkey") % 2500).alias("name"), F.col("o_orderdate").alias("active"))
    found = audits.preceded(events, active, ["name"], "day", "active", 180, names)
    evidence = F.concat(F.lit("event:"), F.col("event").cast("string"))
    return found.join(names, "name").select("entity", "event", "days", "method", "confidence", evidence.alias("evidence"))


@query("""
WITH t AS (SELECT o_custkey, sum(o_totalprice) AS total, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent FROM orders GROUP BY 1),
c AS (SELECT c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE ' ' END AS parent, total, coalesce(urgent, 0) = 1 AS in_graph FROM customer LEFT JOIN t ON c_custkey = o_custkey)
SELECT c_name, in_graph, coalesce(total >= 1000000, false) AS high_value, (coalesce(total >= 1000000, false) AND trim(parent) = '') OR NOT in_graph AS suspect,
  CASE WHEN trim(parent) = '' THEN 'entity_master_unresolved' ELSE 'entity_master_parent_lineage' END AS method, CAST(CASE WHEN trim(parent) = '' THEN 0.35 ELSE 0.95 END AS DOUBLE) AS confidence FROM c
""")
def collapse_suspects(spark, sf_dir):
    """Entities that may have been collapsed wrongly."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    totals = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("total"))
    parent = F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).otherwise(" ")
    entities = c.join(totals, "c_custkey", "left").select("c_name", parent.alias("parent"), "total")
    nodes = c.join(o.filter("o_orderpriority = '1-URGENT'"), c.c_custkey == o.o_custkey, "left_semi").select(F.col("c_name").alias("node"))
    found = audits.collapse_suspects(entities, nodes, "c_name", "parent", "total", "node")
    return found.select("c_name", "in_graph", "high_value", "suspect", "method", "confidence")


@query("""
WITH e AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN event_id - 5 WHEN event_id % 1000 = 1 THEN event_id END AS old FROM events),
p AS (SELECT e.event_id, e.old, t.event_id AS tid, e.user_id <> t.user_id AS u, e.event_type <> t.event_type AS k, e.ts < t.ts AS b FROM e LEFT JOIN events t ON e.old = t.event_id WHERE e.old IS NOT NULL)
SELECT event_id, 'target_missing' AS fault FROM p WHERE tid IS NULL UNION ALL SELECT event_id, 'replaces_itself' FROM p WHERE tid = event_id
UNION ALL SELECT event_id, 'crosses_user_id' FROM p WHERE u UNION ALL SELECT event_id, 'crosses_event_type' FROM p WHERE k UNION ALL SELECT event_id, 'predates_target' FROM p WHERE b
""")
def replacement_faults(spark, sf_dir):
    """Replacements that break a rule of validity."""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").withColumn("old", F.when(k % 7 == 0, k - 5).when(k % 1000 == 1, k))
    return audits.replacement_faults(e, "event_id", "old", ["user_id", "event_type"], ["ts"])


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 1 AS source_row FROM orders")
def source_rows(spark, sf_dir):
    """The line of a headed file that each row stood on."""
    return products.with_source_row(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query("""
WITH s AS (SELECT l_suppkey, sum(l_extendedprice) AS x FROM lineitem GROUP BY 1), t AS (SELECT x FROM s ORDER BY x DESC, l_suppkey LIMIT 10)
SELECT round((SELECT sum(x) FROM s), 2) AS total, round((SELECT sum(x) FROM t), 2) AS top_total, round((SELECT sum(x) FROM t) / (SELECT sum(x) FROM s), 6) AS share
""")
def top_ten_share(spark, sf_dir):
    """What the ten largest suppliers have of all spend."""
    return products.top_share(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice")


@query("""
WITH a AS (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT '{"total_rows":' || (SELECT count(*) FROM orders) || ',"unique_recipients":' || (SELECT count(DISTINCT o_custkey) FROM orders) || ',"by_status":{'
  || (SELECT string_agg('"' || k || '":' || n, ',' ORDER BY k) FROM a) || '},"by_year":{' || (SELECT string_agg('"' || k || '":' || n, ',' ORDER BY k) FROM b) || '}}' AS summary
""")
def awards_summary(spark, sf_dir):
    """The summary of a master table as one JSON text."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    return products.summary_json(o, {"total_rows": F.count("*"), "unique_recipients": F.count_distinct("o_custkey")}, ["status", "year"])


_POLITICAL = """c AS (SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation),
r AS (SELECT o_orderkey AS n, CAST(o_orderkey % 4000 AS VARCHAR) AS record, c_name AS donor, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS cid, 'Committee of ' || c_mktsegment AS cname, o_totalprice AS amount, o_orderdate AS day FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT s_suppkey AS n, CAST(s_suppkey AS VARCHAR) AS record, CAST(s_nationkey + 10 AS VARCHAR) AS cid, 'Payer ' || s_nationkey AS cname, s_name AS recipient, s_acctbal AS amount FROM supplier),
i AS (SELECT upper(replace(s_name, '#', ' ')) AS name, 'ENT_' || s_suppkey AS eid, s_name AS ename FROM supplier WHERE s_acctbal > 5000),
q AS (SELECT p.*, eid, ename, CASE WHEN eid IS NULL THEN 'unresolved' ELSE 'exact_name' END AS method, CASE WHEN eid IS NULL THEN 0.4 ELSE 0.9 END AS confidence FROM p LEFT JOIN i ON upper(replace(recipient, '#', ' ')) = i.name),
x AS (SELECT event_id AS n, CAST(event_id AS VARCHAR) AS record, CAST(user_id % 40 AS VARCHAR) AS cid, 'Spender ' || (user_id % 40) AS cname, CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE '' END AS candidate, 'Candidate ' || user_id AS name, CASE WHEN event_type = 'error' THEN 'oppose' ELSE 'support' END AS stance, value AS amount FROM events),
h AS (SELECT n, record, 'donor_' || substr(sha256(upper(replace(donor, '#', ' '))), 1, 20) AS a, CASE WHEN cid = '' THEN 'committee_' || substr(sha256(upper(cname)), 1, 20) ELSE 'fec_committee:' || cid END AS b, donor, cname, amount, CAST(day AS DATE) AS day FROM r),
k AS (SELECT n, record, 'fec_committee:' || cid AS a, coalesce(eid, 'unresolved_recipient_' || substr(sha256(upper(replace(recipient, '#', ' '))), 1, 20)) AS b, cname, coalesce(ename, recipient) AS recipient, amount, confidence, method, eid, ename FROM q),
z AS (SELECT n, record, 'fec_committee:' || cid AS a, 'fec_candidate:' || CASE WHEN candidate = '' THEN name ELSE candidate END AS b, cname, name, upper(stance) AS stance, amount FROM x)"""


def _political(spark, sf_dir):
    o, c, s, e, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "supplier", "events", "nation"))
    words = lambda c: F.col(c).cast("string")
    committees = n.select(words("n_nationkey").alias("committee_id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 == 0, "Super PAC").otherwise("Leadership").alias("said"), F.lit("").alias("code"), F.col("n_nationkey").cast("long").alias("n"))
    gifts = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").cast("long").alias("n"), (F.col("o_orderkey") % 4000).cast("string").alias("record"), F.col("c_name").alias("donor"), F.when(F.col("o_custkey") % 4 == 0, "").otherwise(words("c_nationkey")).alias("committee_id"),
        F.concat(F.lit("Committee of "), "c_mktsegment").alias("committee_name"), F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("day"),
    )
    paid = s.select(F.col("s_suppkey").cast("long").alias("n"), words("s_suppkey").alias("record"), (F.col("s_nationkey") + 10).cast("string").alias("committee_id"), F.concat(F.lit("Payer "), words("s_nationkey")).alias("committee_name"), F.col("s_name").alias("recipient"), F.col("s_acctbal").alias("amount"), F.lit(None).cast("date").alias("day"))
    user = F.col("user_id") % 40
    spent = e.select(
        F.col("event_id").cast("long").alias("n"), words("event_id").alias("record"), user.cast("string").alias("committee_id"), F.concat(F.lit("Spender "), user.cast("string")).alias("committee_name"), F.when(F.col("user_id") % 2 == 0, words("user_id")).otherwise("").alias("candidate_id"),
        F.concat(F.lit("Candidate "), words("user_id")).alias("candidate_name"), F.when(F.col("event_type") == "error", "oppose").otherwise("support").alias("indicator"), F.col("value").alias("amount"), F.lit(None).cast("date").alias("day"),
    )
    index = s.filter("s_acctbal > 5000").select(F.col("s_name").alias("name"), F.concat(F.lit("ENT_"), words("s_suppkey")).alias("entity_id"), F.col("s_name").alias("entity_name"), F.lit("exact_name").alias("method"), F.lit(0.9).alias("confidence"))
    return political.graph(committees, {"fec_schedule_a": gifts}, paid, spent, index)


@query(f"""WITH {_POLITICAL}, e AS (SELECT 'fec_committee:' || id AS entity_id, CASE WHEN n_nationkey % 3 = 0 THEN 'SUPER_PAC' ELSE 'POLITICAL_COMMITTEE' END AS entity_type, name AS canonical_name, 'fec_committees' AS source_id, id AS source_record_id, 1.0 AS confidence, 0 AS s, n_nationkey AS n, 0 AS side FROM c
 UNION ALL SELECT a, 'DONOR', donor, 'fec_schedule_a', record, 0.9, 1, n, 0 FROM h UNION ALL SELECT b, 'POLITICAL_COMMITTEE', cname, 'fec_schedule_a', record, 0.85, 1, n, 1 FROM h
 UNION ALL SELECT a, 'POLITICAL_COMMITTEE', cname, 'fec_schedule_b', record, 1.0, 4, n, 0 FROM k UNION ALL SELECT b, 'DOWNSTREAM_RECIPIENT', recipient, 'fec_schedule_b', record, confidence, 4, n, 1 FROM k
 UNION ALL SELECT a, 'POLITICAL_COMMITTEE', cname, 'fec_schedule_e', record, 1.0, 5, n, 0 FROM z UNION ALL SELECT b, 'CANDIDATE', name, 'fec_schedule_e', record, 1.0, 5, n, 1 FROM z)
SELECT entity_id, entity_type, canonical_name, source_id, source_record_id, CAST(confidence AS DOUBLE) AS confidence FROM e QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY s, n, side) = 1""")
def political_entities(spark, sf_dir):
    """Nodes of four relations; the first row names a node."""
    return _political(spark, sf_dir)[0]


@query(f"""WITH {_POLITICAL}, e AS (SELECT 'fec_schedule_a' AS source_id, record AS source_record_id, a AS source_entity_id, b AS target_entity_id, 'DONATED_TO' AS edge_type, amount, day, '' AS support_oppose, 0.95 AS confidence, n FROM h
 UNION ALL SELECT 'fec_schedule_b', record, a, b, 'DISBURSED_TO', amount, NULL, '', confidence, n FROM k
 UNION ALL SELECT 'fec_schedule_e', record, a, b, CASE WHEN stance LIKE 'O%' THEN 'INDEPENDENT_EXPENDITURE_AGAINST' ELSE 'INDEPENDENT_EXPENDITURE_FOR' END, amount, NULL, stance, 1.0, n FROM z)
SELECT source_entity_id, target_entity_id, edge_type, amount, day, support_oppose, source_id, source_record_id, CAST(confidence AS DOUBLE) AS confidence FROM e
QUALIFY row_number() OVER (PARTITION BY source_id, source_record_id, source_entity_id, target_entity_id, edge_type ORDER BY n DESC) = 1""")
def political_edges(spark, sf_dir):
    """Edges of four relations; the last row of an id stays."""
    return _political(spark, sf_dir)[1].drop("edge_id")


@query(f"WITH {_POLITICAL} SELECT 'fec_schedule_b' AS source_id, record AS source_record_id, q.recipient AS raw_recipient_name, coalesce(eid, '') AS resolved_entity_id, coalesce(ename, '') AS resolved_name, method AS resolution_method, CAST(confidence AS DOUBLE) AS confidence, eid IS NULL AS review_required FROM q")
def political_resolutions(spark, sf_dir):
    return _political(spark, sf_dir)[2]
