"""Queries on resolution: cascades, places, aliases, restatements, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores, text, values
from ..operators import checks, linkage
from .registry import query, table


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 300 AS VARCHAR) ELSE '' END AS ein, 'Supplier#' || lpad(CAST(c_custkey % 400 AS VARCHAR), 9, '0') AS name FROM customer),
s AS (SELECT s_suppkey, s_name FROM supplier)
SELECT c_custkey, coalesce(a.s_suppkey, b.s_suppkey) AS vendor, CASE WHEN a.s_suppkey IS NOT NULL THEN 'ein' WHEN b.s_suppkey IS NOT NULL THEN 'name' ELSE 'none' END AS matched_by,
  CAST(CASE WHEN a.s_suppkey IS NOT NULL THEN 0.9 WHEN b.s_suppkey IS NOT NULL THEN 0.75 ELSE 0 END AS DOUBLE) AS confidence
FROM c LEFT JOIN s a ON c.ein = CAST(a.s_suppkey AS VARCHAR) LEFT JOIN s b ON c.name = b.s_name
""")
def cascade_match(spark, sf_dir):
    """By identifier, else by name, else nothing."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 3 == 0, (k % 300).cast("string")).otherwise("").alias("ein"),
        F.concat(F.lit("Supplier#"), F.lpad((k % 400).cast("string"), 9, "0")).alias("name"),
    )
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("ein"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("vendor"))
    return linkage.cascade(c, "c_custkey", [("ein", s, "ein", 0.90), ("name", s, "name", 0.75)], "vendor").select("c_custkey", "vendor", "matched_by", "confidence")


@query("""
WITH c AS (SELECT c_custkey, c_nationkey AS n, c_custkey % 4 AS k FROM customer)
SELECT c_custkey, CASE WHEN k = 3 AND n >= 0 THEN NULL ELSE n END AS place, CASE k WHEN 0 THEN 'exact_fips' WHEN 1 THEN 'exact_name' WHEN 2 THEN 'normalized_name' ELSE 'unknown' END AS method FROM c
""")
def geo_resolution(spark, sf_dir):
    """County code, then name as it stands, then normalised name."""
    places = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("72"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code"), text.place_name("n_name").alias("name"), F.col("n_nationkey").alias("place")
    )
    k, n = F.col("c_custkey") % 4, F.col("c_nationkey").cast("string")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k == 0, F.concat(F.lit("72"), F.lpad(n, 3, "0"), F.lit(".0"))).otherwise("99999").alias("code"),
        F.when(k == 1, F.concat(F.lit("NATION "), n)).when(k == 2, F.concat(F.lit("Ciudad de Nátion_"), n)).otherwise("elsewhere").alias("raw"),
    )
    found = linkage.resolve_place(c, text.fips("code"), F.col("raw"), places, text.place_name("raw"))
    return found.select("c_custkey", "place", "method")


@query("""
WITH a AS (SELECT DISTINCT p_name AS alias FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 1) FROM part), t AS (SELECT p_partkey, 'about the ' || p_name || ' of ' || lower(p_type) AS t FROM part),
h AS (SELECT p_partkey, alias, row_number() OVER (PARTITION BY p_partkey ORDER BY length(alias) DESC, alias) AS k FROM t JOIN a ON contains(' ' || t || ' ', ' ' || alias || ' '))
SELECT p_partkey, alias, upper(alias) AS subject FROM h WHERE k = 1
""")
def alias_containment(spark, sf_dir):
    """The longest alias that stands in a text."""
    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_name").alias("alias")).union(p.select(F.split("p_name", " ")[0])).distinct()
    said = p.select("p_partkey", F.concat(F.lit("about the "), "p_name", F.lit(" of "), F.lower("p_type")).alias("t"))
    return linkage.longest_alias(said, "p_partkey", F.split("t", " "), names.withColumn("subject", F.upper("alias")), 2)


@query("""
WITH v AS (SELECT c_custkey, 0 AS place, 'Supplier#' || lpad(CAST(c_custkey * 7 AS VARCHAR), 9, '0') AS name FROM customer UNION ALL SELECT c_custkey, 1, 'Supplier#' || lpad(CAST(c_custkey % 250 AS VARCHAR), 9, '0') FROM customer),
h AS (SELECT c_custkey, s_suppkey AS vendor, name AS variant, row_number() OVER (PARTITION BY c_custkey ORDER BY place) AS k FROM v JOIN supplier ON s_name = name)
SELECT c_custkey, vendor, variant FROM h WHERE k = 1
""")
def variant_join(spark, sf_dir):
    k = F.col("c_custkey")
    names = F.array(*[F.concat(F.lit("Supplier#"), F.lpad(x.cast("string"), 9, "0")) for x in (k * 7, k % 250)])
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("vendor"))
    return linkage.by_variants(table(spark, sf_dir, "customer"), "c_custkey", names, s, "name", "vendor")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events), g AS (SELECT user_id, event_type, d, min(event_id) AS r, count(*) AS n FROM e GROUP BY 1, 2, 3),
l AS (SELECT *, CASE WHEN lag(n) OVER w = 1 THEN lag(r) OVER w END AS restates FROM g WINDOW w AS (PARTITION BY user_id, event_type ORDER BY d))
SELECT event_id, restates FROM e JOIN l USING (user_id, event_type, d)
""")
def restatements(spark, sf_dir):
    """The latest strictly earlier record of the same key, if it is unambiguous."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    return linkage.restated(e, ["user_id", "event_type"], "d", "event_id").select("event_id", "restates")


@query("""
WITH p AS (SELECT o_orderkey AS l, o_custkey AS r, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS a1, CAST(o_custkey % 3 AS VARCHAR) AS b1, CAST(o_orderkey % 2 AS VARCHAR) AS a2, CAST(o_custkey % 2 AS VARCHAR) AS b2 FROM orders)
SELECT l AS left_id, r AS right_id, CAST(CASE WHEN a1 <> '' AND a1 = b1 THEN 1 ELSE 0 END + CASE WHEN a2 = b2 THEN 1 ELSE 0 END AS BIGINT) AS shared, CAST(CASE WHEN a1 <> '' AND a1 <> b1 THEN 1 ELSE 0 END + CASE WHEN a2 <> b2 THEN 1 ELSE 0 END AS BIGINT) AS disagree FROM p
""")
def identifier_agreement(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = lambda name, a, b: F.struct(F.lit(name).alias("namespace"), a.alias("a"), b.alias("b"))
    both = F.array(
        pair("uei", F.when(k % 5 == 0, "").otherwise((k % 3).cast("string")), (c % 3).cast("string")), pair("ein", (k % 2).cast("string"), (c % 2).cast("string"))
    )
    ids = o.select(k.alias("left_id"), c.alias("right_id"), F.explode(both).alias("x")).select("left_id", "right_id", "x.*")
    return linkage.agreement(ids, "left_id", "right_id")


@query("""
SELECT p_type AS namespace, p_size AS identifier, count(DISTINCT p_brand) AS subjects FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_brand) > 1
""")
def namespace_occupancy(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_type").alias("namespace"), F.col("p_size").alias("identifier"), "p_brand")
    return linkage.namespace_conflicts(p, "namespace", "identifier", "p_brand")


@query("""
SELECT coalesce(s_suppkey, c_custkey) AS k, CASE WHEN s_suppkey IS NULL THEN 'old' ELSE 'new' END AS version, CASE WHEN s_suppkey IS NULL THEN c_acctbal ELSE s_acctbal END AS balance FROM customer FULL JOIN supplier ON c_custkey = s_suppkey
""")
def snapshot_merge(spark, sf_dir):
    """All customers as the old rows, all suppliers as the new ones."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("old").alias("version"), F.col("c_acctbal").alias("balance"))
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("new").alias("version"), F.col("s_acctbal").alias("balance"))
    return linkage.merged_snapshot(old, new, "k")


@query("""
SELECT a.s_nationkey AS nation, a.s_suppkey AS member, b.s_suppkey AS head FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey % 9 <> 0 AND b.s_suppkey % 9 = 0
""")
def group_heads(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", F.when(F.col("s_suppkey") % 9 == 0, "central").otherwise("subordinate").alias("role"))
    return linkage.self_pairs(s, "nation", "role", "central", "s_suppkey")


@query("""
WITH r AS (SELECT l_orderkey, max(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS k FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE k WHEN 0 THEN 'observed' WHEN 1 THEN 'linked' ELSE 'blocked' END AS tier FROM r
""")
def claim_tiers(spark, sf_dir):
    """The worst tier among the sources of a claim; an unknown source blocks."""
    tiers = spark.sql("SELECT * FROM VALUES ('A', 'observed'), ('N', 'linked') AS t(source, tier)")
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("s"))
    return linkage.worst_tier(o, "l_orderkey", F.col("s"), tiers, ["observed", "linked", "blocked"])


@query("""
WITH RECURSIVE w(node, wave) AS (SELECT n_nationkey, 0 FROM nation UNION SELECT n.n_nationkey, wave + 1 FROM w JOIN nation n ON n.n_nationkey = w.node * 2 + 1 OR n.n_nationkey = w.node * 3 + 2 WHERE wave < 20)
SELECT node, CAST(max(wave) AS INTEGER) AS wave FROM w GROUP BY node
""")
def dependency_waves(spark, sf_dir):
    """Sources in the order in which they can be updated."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node"))
    needs = n.select(F.explode(F.array(F.struct((F.col("node") * 2 + 1).alias("node"), F.col("node").alias("needs")), F.struct((F.col("node") * 3 + 2).alias("node"), F.col("node").alias("needs")))).alias("e")).select("e.*")
    return linkage.waves(needs.join(n, "node", "left_semi"), n)


@query("""
SELECT c_nationkey AS place, c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS total, CAST(sum(CASE WHEN c_custkey % 3 = 0 THEN 97 ELSE 50 END) AS BIGINT) AS confidence_points, round(count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey), 4) AS share FROM customer GROUP BY 1, 2
""")
def density_and_reasons(spark, sf_dir):
    """Counts by several keys with summed confidence (hundredths) and the share in the first key."""
    from pyspark.sql import Window

    g = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("segment"))
    sure = F.when(F.col("c_custkey") % 3 == 0, 97).otherwise(50)
    d = g.agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.sum(sure).alias("confidence_points"))
    return d.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("place")), 4))


@query("""
SELECT avg(CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END END) AS public_raw, round(avg(CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END END) * 0.5
  + avg(CASE WHEN o_orderkey % 4 > 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 1.0 ELSE 0 END END) * 0.3 + avg(CASE WHEN o_orderkey % 4 > 0 THEN (o_custkey % 10) / 10.0 END) * 0.2, 4) AS score FROM orders
""")
def coverage_score(spark, sf_dir):
    """Weighted shares of public, resolvable and confident rows; structurally unavailable rows are left out."""
    there = F.col("o_orderkey") % 4 > 0
    mean = lambda c: F.avg(F.when(there, c))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    public = mean(flag(F.col("o_orderstatus") == "F"))
    score = public * 0.5 + mean(flag(F.col("o_custkey") % 2 == 0)) * 0.3 + mean((F.col("o_custkey") % 10) / 10) * 0.2
    return table(spark, sf_dir, "orders").agg(public.alias("public_raw"), F.round(score, 4).alias("score"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, abs(l_extendedprice - (round(l_extendedprice * 0.6, 2) + round(l_extendedprice * 0.3, 2) + round(l_extendedprice * 0.1, 2) + CASE WHEN l_orderkey % 50 = 0 THEN 5 ELSE 0 END)) <= 0.05 AS closed FROM lineitem
""")
def closure_check(spark, sf_dir):
    """Authorised is disbursed plus cancelled plus balance, within a tolerance."""
    x = F.col("l_extendedprice")
    parts = F.round(x * 0.6, 2) + F.round(x * 0.3, 2) + F.round(x * 0.1, 2) + F.when(F.col("l_orderkey") % 50 == 0, 5).otherwise(0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", (F.abs(x - parts) <= 0.05).alias("closed"))


@query("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END <= 1
""")
def visibility_filter(spark, sf_dir):
    """Rows that a clearance may see."""
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return table(spark, sf_dir, "orders").filter(rank <= 1).select("o_orderkey", "o_orderpriority")


@query("""
WITH s AS (SELECT event_id, CASE WHEN value > 60 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END + CASE WHEN event_type = 'click' THEN 20 ELSE 0 END + CASE WHEN user_id % 3 = 0 THEN 15 ELSE 0 END + CASE WHEN value > 30 THEN 10 ELSE 0 END - CASE WHEN event_type = 'error' THEN 20 ELSE 0 END AS raw, CAST(user_id % 4 AS INTEGER) AS families, CAST(user_id % 9 AS INTEGER) AS stage FROM events),
t AS (SELECT *, least(100, greatest(0, raw + CASE WHEN families >= 3 THEN 15 WHEN families = 2 THEN 10 ELSE 0 END)) AS score FROM s)
SELECT event_id, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 90 AND families >= 2 AND stage >= 5 THEN 'critical' WHEN score >= 75 THEN 'urgent' WHEN score >= 55 THEN 'review' WHEN score >= 35 THEN 'watch' ELSE 'none' END AS level FROM t
""")
def project_alerts(spark, sf_dir):
    """Additive alert points with levels; critical needs two families and a late stage or a large amount."""
    kind, v = F.col("event_type"), F.col("value")
    families, stage = (F.col("user_id") % 4).cast("int"), (F.col("user_id") % 9).cast("int")
    points = scores.additive([(v > 60, 30), (kind == "purchase", 20), (kind == "click", 20), (F.col("user_id") % 3 == 0, 15), (v > 30, 10), (kind == "error", -20), (families >= 3, 15), (families == 2, 10)])
    score = F.least(F.greatest(points, F.lit(0.0)), F.lit(100.0))
    return table(spark, sf_dir, "events").select("event_id", score.alias("score"), scores.alert_level(score, families, stage, F.lit(0.0)).alias("level"))


@query("""
SELECT 'awd_' || substr(sha256('award|' || o_orderkey), 1, 32) AS award_id, 'ent_' || substr(sha256('entity|' || o_custkey), 1, 32) AS recipient_id, c_nationkey AS place, 'orders:' || o_orderkey AS source_record_id, year(o_orderdate) AS year FROM orders JOIN customer ON o_custkey = c_custkey
""")
def export_stream(spark, sf_dir):
    """Awards in the exchange format: nested location and lineage, read back here as columns."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    o = table(spark, sf_dir, "orders").join(c, "o_custkey")
    nested = o.select(
        text.federation_id("awd", "award", F.col("o_orderkey").cast("string")).alias("award_id"),
        text.federation_id("ent", "entity", F.col("o_custkey").cast("string")).alias("recipient_id"),
        F.struct(F.col("c_nationkey").alias("place")).alias("location"),
        F.struct(F.concat_ws(":", F.lit("orders"), F.col("o_orderkey").cast("string")).alias("source_record_id"), F.year("o_orderdate").alias("year")).alias("lineage"),
    )
    return nested.select("award_id", "recipient_id", "location.place", "lineage.source_record_id", "lineage.year")


@query("""
SELECT 'supplier' AS side, count(*) AS rows_in, count(*) FILTER (WHERE s_acctbal > 0) AS rows_out, 'positive balance' AS rule FROM supplier UNION ALL SELECT 'customer', count(*), count(*) FILTER (WHERE c_acctbal > 0), 'positive balance' FROM customer
""")
def row_accounting(spark, sf_dir):
    """Rows in and out of a step, written down even if there are none."""
    one = lambda name, df, c: df.agg(F.lit(name).alias("side"), F.count("*").alias("rows_in"), F.count(F.when(F.col(c) > 0, 1)).alias("rows_out"), F.lit("positive balance").alias("rule"))
    return checks.union_all([one("supplier", table(spark, sf_dir, "supplier"), "s_acctbal"), one("customer", table(spark, sf_dir, "customer"), "c_acctbal")])


@query("""
SELECT o_orderkey, o_custkey % 2 = 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1998-06-30' OR o_custkey % 2 = 1 AND CAST(o_orderdate AS DATE) >= DATE '1997-01-01' AS valid FROM orders
""")
def identifier_validity(spark, sf_dir):
    """Open-ended validity of an identifier on a day."""
    even = F.col("o_custkey") % 2 == 0
    start = F.when(even, F.lit("1995-01-01")).otherwise(F.lit("1997-01-01")).cast("date")
    end = F.when(even, F.lit("1998-06-30")).cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", values.valid_on(start, end, F.to_date("o_orderdate")).alias("valid"))
