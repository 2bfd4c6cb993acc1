"""Queries over rows: normalisers, deduplication, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores, similarity, text, values
from ..operators import aggregates, dedup, joins
from .registry import query, table


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
  CASE WHEN o_orderkey % 3 = 0 THEN -round(o_totalprice, 2) WHEN o_orderkey % 7 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS amount,
  CASE WHEN o_custkey % 4 = 0 THEN 'PR' WHEN o_custkey % 4 = 1 THEN 'PR' WHEN o_custkey % 4 = 2 THEN 'NY' ELSE '' END AS state,
  CASE WHEN o_custkey % 2 = 0 THEN '72' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') ELSE '' END AS county
FROM orders
""")
def value_parsers(spark, sf_dir):
    """Money, dates, states and county codes from text."""
    o = table(spark, sf_dir, "orders")
    money = F.format_number(F.round("o_totalprice", 2), 2)
    dirty = o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("d"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("($"), money, F.lit(")")))
        .when(F.col("o_orderkey") % 7 == 0, "n/a")
        .otherwise(F.concat(F.lit("$"), money))
        .alias("m"),
        F.element_at(F.array(F.lit(" Puerto Rico"), F.lit("72"), F.lit("NY "), F.lit("")), (F.col("o_custkey") % 4 + 1).cast("int")).alias("s"),
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("72"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit(".0")))
        .otherwise("12345")
        .alias("c"),
    )
    return dirty.select(
        "o_orderkey",
        values.fiscal_year(values.date_of(F.col("d"))).alias("fiscal_year"),
        values.money(F.col("m")).alias("amount"),
        values.state_code(F.col("s")).alias("state"),
        text.fips("c").alias("county"),
    )


@query("""
WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE
  'Municipio de ' || c_mktsegment || ' & Cía., S.A. Inc ' || c_custkey END AS raw FROM customer)
SELECT c_custkey,
  CASE WHEN raw IS NULL THEN '' ELSE 'MUNICIPIO ' || (SELECT c_mktsegment FROM customer c WHERE c.c_custkey = n.c_custkey) || ' AND CIA ' || c_custkey END AS org,
  CASE WHEN raw IS NULL THEN '' ELSE trim(regexp_replace(regexp_replace(upper(strip_accents(raw)), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) END AS person,
  CASE WHEN raw IS NULL THEN 'na' ELSE trim(regexp_replace(lower(raw), '[^a-z0-9]+', '_', 'g'), '_') END AS slug,
  'entity_' || substr(sha256(CASE WHEN raw IS NULL THEN '' ELSE 'MUNICIPIO ' || (SELECT c_mktsegment FROM customer c WHERE c.c_custkey = n.c_custkey) || ' AND CIA ' || c_custkey END), 1, 16) AS entity_id
FROM n
""")
def name_normalize(spark, sf_dir):
    """Organisation and person names, slugs and deterministic ids."""
    c = table(spark, sf_dir, "customer")
    raw = F.when(
        F.col("c_custkey") % 5 != 0, F.concat(F.lit("Municipio de "), "c_mktsegment", F.lit(" & Cía., S.A. Inc "), F.col("c_custkey").cast("string"))
    )
    n = c.select("c_custkey", raw.alias("raw"))
    return n.select(
        "c_custkey",
        text.org_name("raw").alias("org"),
        text.person_name("raw").alias("person"),
        text.slug("raw").alias("slug"),
        text.node_id("entity", "raw").alias("entity_id"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || ' HEALTH' ELSE upper(p_name) END
    || CASE WHEN p_partkey % 3 = 0 THEN ' X' ELSE '' END AS trailing,
  upper(p_name) || ' AVE ' || p_size AS street, right('1787555' || lpad(CAST(p_partkey AS VARCHAR), 4, '0'), 10) AS phone
FROM part
""")
def contact_normalize(spark, sf_dir):
    """Trailing words, street words and telephone numbers."""
    p = table(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" Health x, Inc."))).otherwise(F.concat("p_name", F.lit(", The Hospital Corp.")))
    return p.select(
        "p_partkey",
        text.trailing_name(raw).alias("trailing"),
        text.address(F.concat("p_name", F.lit(", Avenue "), F.col("p_size").cast("string"))).alias("street"),
        text.phone(F.concat(F.lit("+1 (787) 555-"), F.lpad(F.col("p_partkey").cast("string"), 4, "0"))).alias("phone"),
    )


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS dataset,
  CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE l_orderkey || '-' || l_linenumber END AS award_id, round(l_extendedprice, 2) AS amount FROM lineitem),
a AS (SELECT *, row_number() OVER (PARTITION BY dataset, award_id ORDER BY l_orderkey, l_partkey, l_suppkey, amount) AS k FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY award_id ORDER BY CASE dataset WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, l_orderkey, l_partkey, l_suppkey, amount) AS j
  FROM a WHERE k = 1 OR award_id = '')
SELECT dataset, award_id, l_orderkey, l_partkey, l_suppkey, amount FROM b WHERE j = 1 OR award_id = ''
""")
def dedup_priority(spark, sf_dir):
    """Awards once per dataset, then once overall by dataset priority; rows without id stay."""
    award = F.when(F.col("l_orderkey") % 11 == 0, "").otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("dataset"), award.alias("award_id"), "l_orderkey", "l_partkey", "l_suppkey", F.round("l_extendedprice", 2).alias("amount")
    )
    priority = F.when(F.col("dataset") == "A", 1).when(F.col("dataset") == "N", 2).otherwise(3)
    return dedup.by_priority(rows, "dataset", "award_id", priority, F.struct("l_orderkey", "l_partkey", "l_suppkey", "amount"))


@query("""
SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS k FROM events) WHERE k = 1
""")
def latest_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return dedup.best_per_key(e, ["user_id", "event_type"], [(-F.unix_micros(F.col("ts").cast("timestamp"))).alias("t"), F.col("event_id")])


@query("""
WITH s AS (SELECT l_suppkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags,
  arg_min(l_linestatus, (l_orderkey, l_partkey)) FILTER (WHERE l_orderkey % 3 <> 0) AS status, min((l_orderkey, l_partkey)) AS k FROM lineitem GROUP BY l_suppkey)
SELECT s.l_suppkey, flags, status, k[1] AS l_orderkey, k[2] AS l_partkey FROM s
""")
def merge_dedup(spark, sf_dir):
    """One row per supplier: flags joined, first filled status, rest from the first row."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("flags"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_linestatus")).alias("status"),
        "l_orderkey",
        "l_partkey",
    )
    return dedup.merged(rows, "l_suppkey", "flags", "status", F.struct("l_orderkey", "l_partkey"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sha256(l_orderkey || '|' || l_linenumber) AS fingerprint,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS duplicates,
  CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'duplicate' ELSE 'unique' END AS status FROM lineitem
""")
def duplicate_fingerprints(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup.duplicate_status(rows, F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber"), 256))


@query("""
SELECT user_id, event_type, ts, event_id, 1 AS ties FROM (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1
""")
def current_position(spark, sf_dir):
    """The current row of each key, with the number of rows that claim to be it."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return dedup.latest_or_tie(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).withColumn("ties", F.col("ties").cast("int"))


@query("""
SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.event_id % 7 = 0 AND f.event_id - 5 = e.event_id)
""")
def supersession(spark, sf_dir):
    """Rows that no amendment replaces (every seventh row replaces the fifth before it)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 7 == 0, F.col("event_id") - 5).alias("replaces"))
    return dedup.superseded(e, "event_id", "replaces").select("event_id", "user_id")


@query("""
SELECT o_orderkey, s.l_suppkey AS l_suppkey, s.l_partkey AS l_partkey FROM orders LEFT JOIN
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1) s ON o_orderkey = s.l_orderkey
""")
def first_wins_lookup(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    order = [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return joins.lookup_first(o, lines, ["o_orderkey"], order).select("o_orderkey", "l_suppkey", "l_partkey")


@query("""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'contract'
  WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 'subaward'
  WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN 'bond' ELSE 'unmatched' END AS anchor FROM customer
""")
def anchor_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    tables = [("contract", o.filter("o_orderstatus = 'P'")), ("subaward", o.filter("o_orderpriority = '1-URGENT'")), ("bond", o.filter("o_totalprice > 400000"))]
    return joins.anchor(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", tables)


@query("""
SELECT coalesce(a.k, b.k) AS nation, a.n AS suppliers, b.n AS customers,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'supplier' ELSE 'customer' END AS provenance
FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) a FULL JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) b ON a.k = b.k
""")
def outer_bridge(spark, sf_dir):
    """outer_bridge over all nations."""
    a = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    b = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    return joins.bridge(a, b, "nation", "supplier", "customer")


@query("""
WITH i AS (SELECT s_name AS key, s_suppkey AS vendor, s_suppkey AS ord FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_suppkey, s_suppkey FROM supplier),
p AS (SELECT c_custkey, 0 AS place, CASE WHEN c_custkey % 3 = 0 THEN 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS key FROM customer
  UNION ALL SELECT c_custkey, 1, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 500 AS VARCHAR) ELSE ' ' END FROM customer),
h AS (SELECT c_custkey, place, vendor, row_number() OVER (PARTITION BY c_custkey ORDER BY place, ord) AS k FROM p JOIN i ON trim(p.key) = i.key)
SELECT c.c_custkey, CAST(h.place AS INTEGER) AS matched_place, h.vendor FROM customer c LEFT JOIN h ON c.c_custkey = h.c_custkey AND h.k = 1
""")
def any_key_join(spark, sf_dir):
    """A row matches by the first of several identifier columns that is known."""
    s = table(spark, sf_dir, "supplier")
    index = s.select(F.col("s_name").alias("key"), F.col("s_suppkey").alias("vendor"), F.col("s_suppkey").alias("ord")).unionByName(
        s.select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_suppkey").alias("vendor"), F.col("s_suppkey").alias("ord"))
    )
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 3 == 0, F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))).alias("name_key"),
        F.when(k % 2 == 0, (k % 500).cast("string")).otherwise(" ").alias("id_key"),
    )
    return joins.any_key(c, "c_custkey", ["name_key", "id_key"], index, "vendor", "ord").select("c_custkey", "matched_place", "vendor")


@query("""
SELECT p.p_partkey AS project, q.p_partkey AS segment, round(greatest(least(p.p_retailprice + 30, q.p_retailprice + 12.5) - greatest(p.p_retailprice, q.p_retailprice), 0) / 12.5, 4) AS share
FROM part p JOIN part q ON p.p_brand = q.p_brand AND p.p_partkey <> q.p_partkey
  AND p.p_retailprice <= q.p_retailprice + 12.5 AND q.p_retailprice <= p.p_retailprice + 30
WHERE greatest(least(p.p_retailprice + 30, q.p_retailprice + 12.5) - greatest(p.p_retailprice, q.p_retailprice), 0) / 12.5 >= 0.2
""")
def overlap_join(spark, sf_dir):
    """overlap_join with all parts on both sides."""
    p = table(spark, sf_dir, "part")
    a = p.select(F.col("p_partkey").alias("project"), F.col("p_brand").alias("route"), F.col("p_retailprice").alias("lo"), (F.col("p_retailprice") + 30).alias("hi"))
    b = p.select(F.col("p_partkey").alias("segment"), F.col("p_brand").alias("route"), F.col("p_retailprice").alias("slo"), (F.col("p_retailprice") + 12.5).alias("shi"))
    share = values.overlap_share(F.col("lo"), F.col("hi"), F.col("slo"), F.col("shi"))
    pairs = joins.overlap(a, b, "route", "lo", "hi", "slo", "shi", 50.0, {"s": share, "share": F.round(share, 4)})
    return pairs.filter("s >= 0.2 AND project <> segment").select("project", "segment", "share")


@query("""
SELECT p.event_id AS posting, count(f.event_id) AS filings, CAST(date_diff('second', max(f.ts), p.ts) AS BIGINT) AS lead_seconds, round(sum(f.value), 2) AS spend
FROM events p JOIN events f ON p.user_id = f.user_id AND f.event_type = 'click' AND f.ts BETWEEN p.ts - INTERVAL 2 DAY AND p.ts
WHERE p.event_type = 'purchase' GROUP BY p.event_id, p.ts
""")
def band_window_join(spark, sf_dir):
    """Filings in a window before a posting."""
    e = table(spark, sf_dir, "events")
    p = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("posting"), "user_id", "ts")
    f = e.filter("event_type = 'click'").select("user_id", F.col("ts").alias("filed"), "value")
    pairs = joins.band(p, f, ["user_id"], "ts", "filed", 2 * 86400)
    lead = F.timestamp_diff("SECOND", F.date_trunc("second", F.max("filed")), F.date_trunc("second", F.first("ts")))
    return pairs.groupBy("posting").agg(F.count("*").alias("filings"), lead.alias("lead_seconds"), F.round(F.sum("value"), 2).alias("spend"))


@query("""
SELECT l.event_id, r.ts AS asof_time, r.event_id AS asof_value FROM (SELECT * FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r ON l.user_id = r.user_id AND l.ts > r.ts
""")
def asof_strict(spark, sf_dir):
    """The latest strictly earlier filing."""
    e = table(spark, sf_dir, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'click'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("v"), F.col("event_id").alias("tie"))
    return joins.asof_before(left, right, ["user_id"], "ts", "t", "v", "tie").select("event_id", "asof_time", "asof_value")


@query("""
SELECT p_name, min(p_partkey) AS p_partkey FROM (SELECT p_name || '/' || p_brand AS p_name, p_partkey FROM part) GROUP BY p_name HAVING count(DISTINCT p_partkey) = 1
""")
def unique_resolution(spark, sf_dir):
    """Names that resolve to exactly one id."""
    p = table(spark, sf_dir, "part").select(F.concat_ws("/", "p_name", "p_brand").alias("p_name"), "p_partkey")
    return joins.unique_only(p, "p_name", "p_partkey")


@query("""
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS m FROM customer GROUP BY 1)
SELECT max(n) AS most_left, max(m) AS most_right, count(*) FILTER (WHERE m IS NULL) AS left_only, count(*) FILTER (WHERE n IS NULL) AS right_only,
  CAST(sum(coalesce(n * m, 0)) AS BIGINT) AS pairs, 'many_to_one' AS kind FROM a FULL JOIN b ON a.k = b.k
""")
def join_cardinality(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return joins.cardinality(o, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k")


@query()
def fuzzy_best(spark, sf_dir):
    """fuzzy_best with all parts on both sides: each part's best other part (a cross join in SQL; tests compare by brute force)."""
    words = similarity.tokens(F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vendor"), words.alias("x"))
    return joins.jaccard_best_other(p, "vendor", "x", "registered", 0.6).withColumn("score", F.round("score", 4))


@query()
def fuzzy_edit_best(spark, sf_dir):
    """Token-set and sequence ratios of names that share a word (no SQL for them)."""
    p = table(spark, sf_dir, "part").select("p_name").distinct()
    a = p.select(F.col("p_name").alias("a"), F.explode(similarity.tokens(F.col("p_name"))).alias("w"))
    b = p.select(F.concat("p_name", F.lit("s")).alias("b"), F.explode(similarity.tokens(F.col("p_name"))).alias("w"))
    pairs = a.join(b, "w").select("a", "b").distinct()
    return pairs.withColumns({"token_set": F.round(similarity.token_set_ratio("a", "b"), 4), "sequence": F.round(similarity.sequence_ratio("a", "b"), 4)})


@query("""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'both' ELSE 'left_only' END AS side FROM customer
UNION ALL SELECT DISTINCT o_custkey, 'right_only' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def set_compare(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return aggregates.set_compare(table(spark, sf_dir, "customer").select("c_custkey"), o, "c_custkey")


@query("""
SELECT o_orderkey AS subject, 'no_lines' AS gap FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT c_custkey, 'no_orders' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT s_suppkey, 'negative_balance' FROM supplier WHERE s_acctbal < 0
""")
def gap_anti_join(spark, sf_dir):
    """Tagged union of what is missing."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    a = o.join(lines, "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("subject"), F.lit("no_lines").alias("gap"))
    b = c.join(o.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti").select(F.col("c_custkey").alias("subject"), F.lit("no_orders").alias("gap"))
    s = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("subject"), F.lit("negative_balance").alias("gap"))
    return a.unionByName(b).unionByName(s)


@query("""
SELECT o_orderkey, round(least(CASE WHEN o_orderkey % 2 = 0 THEN 0.40 WHEN o_orderkey % 3 = 0 THEN 0.25 ELSE 0 END
  + CASE WHEN o_orderstatus = 'F' THEN 0.20 ELSE 0 END + CASE WHEN o_totalprice > 100000 THEN 0.15 ELSE 0 END
  + CASE WHEN o_custkey % 2 = 0 THEN 0.15 ELSE 0 END + CASE WHEN o_custkey % 5 = 0 THEN 0.05 ELSE 0 END + CASE WHEN o_custkey % 7 = 0 THEN 0.05 ELSE 0 END, 1), 3) AS confidence
FROM orders
""")
def link_confidence(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    score = scores.link_confidence(k % 2 == 0, k % 3 == 0, F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000, c % 2 == 0, c % 5 == 0, c % 7 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", score.alias("confidence"))


@query("""
WITH f AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS e, (c_custkey % 11) / 10.0 AS n, c_custkey % 5 = 0 AS a FROM customer),
s AS (SELECT k, e, n, a, round(CASE WHEN e THEN least(0.6 + least(n, 1) * 0.55 + CASE WHEN a THEN 0.35 ELSE 0 END, 1)
  ELSE least(least(least(n, 1) * 0.55 + CASE WHEN a THEN 0.35 ELSE 0 END, 1), 0.9) END, 4) AS score FROM f)
SELECT k AS c_custkey, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 0.95 AND e THEN 'auto_merge' WHEN score >= 0.85 THEN 'suggested_merge' WHEN score >= 0.65 THEN 'possible_relationship' ELSE 'separate' END AS decision FROM s
""")
def match_score_band(spark, sf_dir):
    k = F.col("c_custkey")
    features = {"exact_id": k % 3 == 0, "name": (k % 11) / F.lit(10.0), "alias": k % 5 == 0}
    c = table(spark, sf_dir, "customer").select("c_custkey", scores.match_score(features).alias("score"))
    return c.withColumn("decision", scores.match_decision(F.col("score"), k % 3 == 0, F.lit(False)))


@query("""
SELECT o_orderkey, round((0.35 * CASE WHEN o_orderkey % 4 = 0 THEN 0.5 ELSE (o_orderkey % 10) / 10.0 END + 0.30 * CASE WHEN o_orderkey % 5 = 0 THEN 0.5 ELSE (o_custkey % 10) / 10.0 END
  + 0.20 * (o_orderkey % 2) + 0.15 * (o_custkey % 2)) * 100, 1) AS score FROM orders
""")
def delivery_score(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    s = scores.delivery(F.when(k % 4 != 0, (k % 10) / 10), F.when(k % 5 != 0, (c % 10) / 10), k % 2, c % 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", s.cast("double").alias("score"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(t, 'amendment|modification|change order|expansion') THEN 8 WHEN regexp_matches(t, 'maintenance|security|operations|staffing|concession') THEN 7
  WHEN regexp_matches(t, 'construction|site work|materials|earthwork|build') THEN 6 WHEN regexp_matches(t, 'road|water|power|substation|drainage|telecom|utility') THEN 5
  WHEN regexp_matches(t, 'engineering|design|study|legal|consulting|architecture') THEN 4 WHEN regexp_matches(t, 'grant|funding|budget|bond|appropriation') THEN 3
  WHEN regexp_matches(t, 'permit|zoning|environmental|public hearing|land use') THEN 2 WHEN regexp_matches(t, 'llc|corporation|registered agent|entity') THEN 1 ELSE 0 END AS stage,
  CAST(contains(t, 'the') AS INTEGER) + CAST(contains(t, 'que') AS INTEGER) + CAST(contains(t, 'sch') AS INTEGER) AS hits
FROM (SELECT doc_id, lower(text) AS t FROM documents)
""")
def keyword_classify(spark, sf_dir):
    """Project stage by the first rule that fits, and a scored category."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", scores.project_stage(F.col("text")).alias("stage"), scores.keyword_hits(F.lower("text"), ("the", "que", "sch")).alias("hits"))


@query("""
WITH rules(domain, word) AS (VALUES ('budget', 'que'), ('budget', 'der'), ('permits', 'the'), ('contracts', 'tion'), ('contracts', 'ción')),
h AS (SELECT DISTINCT page_id, domain FROM pages, rules WHERE contains(lower(html), word)),
g AS (SELECT page_id, string_agg(domain, '|' ORDER BY domain) AS domains FROM h GROUP BY page_id)
SELECT p.page_id, coalesce(domains, '') AS domains, CASE WHEN domains IS NULL THEN 'review' WHEN contains(domains, 'contracts') THEN 'canonical' ELSE 'derivative' END AS route
FROM pages p LEFT JOIN g ON p.page_id = g.page_id
""")
def route_items(spark, sf_dir):
    """Domains by rule words; every item gets a route, none is lost."""
    rules = {"budget": ("que", "der"), "permits": ("the",), "contracts": ("tion", "ción")}
    low = F.lower("html")
    domains = F.array_compact(F.array(*[F.when(scores.keyword_hits(low, w) > 0, d) for d, w in sorted(rules.items())]))
    routed = table(spark, sf_dir, "pages").select("page_id", domains.alias("d"))
    route = F.when(F.size("d") == 0, "review").when(F.array_contains("d", "contracts"), "canonical").otherwise("derivative")
    return routed.select("page_id", F.array_join("d", "|").alias("domains"), route.alias("route"))


@query("""
SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '<a href=')) AS links,
  regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages
""")
def pages_extract(spark, sf_dir):
    """Title, links and host of raw pages."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.regexp_count("html", F.lit("<a href=")).alias("links"),
        F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"),
    )


@query("""
SELECT d.doc_id, b.item_id FROM (SELECT doc_id, lower(text) AS t FROM documents) d JOIN (SELECT item_id, lower(text) AS w FROM benchmark) b ON contains(d.t, b.w)
""")
def watchlist_matches(spark, sf_dir):
    """Documents that hold a watchlist text: found by the rarest of its inner words, which are whole wherever it occurs, then checked.

    Only ids travel beside words; texts are joined to candidates by id.  Watchlist texts
    of at most two words have no inner word and are held against every document.
    """
    runs = lambda c: F.regexp_extract_all(c, F.lit(r"(?U)[^\s]+"), F.lit(0))
    d = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.lower("text").alias("w")).withColumn("runs", runs(F.col("w")))
    inner = b.filter(F.size("runs") > 2).select("item_id", F.explode(F.array_distinct(F.slice("runs", F.lit(2), F.size("runs") - 2))).alias("key"))
    words = d.select("doc_id", F.explode(F.array_distinct(runs(F.col("t")))).alias("key")).join(inner.select("key").distinct(), "key", "left_semi")
    n = words.groupBy("key").agg(F.count("*").alias("n"))
    rarest = inner.join(n, "key", "left").groupBy("item_id").agg(F.min_by("key", F.struct(F.coalesce("n", F.lit(0)), "key")).alias("key"))
    pairs = words.join(rarest, "key").select("doc_id", "item_id").distinct()
    hit = pairs.join(d, "doc_id").join(b.select("item_id", "w"), "item_id").filter(F.contains("t", "w")).select("doc_id", "item_id")
    short = b.filter(F.size("runs") <= 2).select("item_id", "w")
    return hit.unionByName(d.join(short, F.contains("t", "w")).select("doc_id", "item_id")).distinct()


@query("""
WITH n AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'Dept of Roads ' WHEN 1 THEN 'FUNDACIÓN ' WHEN 2 THEN 'Rivera, Juan ' WHEN 3 THEN 'Acme, LLC ' WHEN 4 THEN 'Varios ' WHEN 5 THEN 'Undisclosed ' WHEN 6 THEN ' '
  WHEN 7 THEN 'Junta de Planificación ' ELSE 'Catedral, de la Ciudad de San ' END || CASE WHEN c_custkey % 9 = 6 THEN '' ELSE c_name END AS name FROM customer)
SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'government' WHEN 1 THEN 'nonprofit' WHEN 2 THEN 'individual' WHEN 5 THEN 'aggregate' WHEN 6 THEN 'unknown' WHEN 7 THEN 'government' ELSE 'corporate' END AS kind FROM n
""")
def entity_kinds(spark, sf_dir):
    """Kinds of entity by their names."""
    heads = ("Dept of Roads ", "FUNDACIÓN ", "Rivera, Juan ", "Acme, LLC ", "Varios ", "Undisclosed ", " ", "Junta de Planificación ", "Catedral, de la Ciudad de San ")
    head = F.get(F.array(*[F.lit(h) for h in heads]), (F.col("c_custkey") % 9).cast("int"))
    name = F.concat(head, F.when(F.col("c_custkey") % 9 == 6, "").otherwise(F.col("c_name")))
    return table(spark, sf_dir, "customer").select("c_custkey", scores.entity_kind(name).alias("kind"))
