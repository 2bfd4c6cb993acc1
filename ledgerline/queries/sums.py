"""Queries over groups: aggregates, ranks, scores, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scores, values
from ..operators import aggregates, checks
from ..plans import products
from .registry import lost_key, query, table

# Fixed value: rows of one task where all of them are held.
_LINES = 1_000_000


@query("""
WITH s AS (SELECT l_suppkey AS vendor, round(sum(l_extendedprice * (1 - l_discount)), 2) AS spend FROM lineitem GROUP BY 1),
r AS (SELECT l_suppkey AS vendor, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey) AS k FROM lineitem),
e AS (SELECT vendor, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY k) AS evidence FROM r WHERE k <= 5 GROUP BY 1)
SELECT s.vendor, s_name AS name, spend, round(spend / (SELECT sum(spend) FROM s), 6) AS share, CASE WHEN spend / (SELECT sum(spend) FROM s) >= 0.40 THEN 'high' ELSE 'medium' END AS severity,
  row_number() OVER (ORDER BY spend DESC, s.vendor) AS rank, evidence FROM s JOIN e ON s.vendor = e.vendor JOIN supplier ON s_suppkey = s.vendor WHERE spend / (SELECT sum(spend) FROM s) >= 0.005
""")
def entity_concentration(spark, sf_dir):
    """Vendors by share of all spend, with their five largest awards as evidence."""
    lines = table(spark, sf_dir, "lineitem")
    spend = lines.groupBy(F.col("l_suppkey").alias("vendor")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("spend"))
    shared = aggregates.with_share(spend, "spend").filter("share >= 0.005")
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_partkey")]
    evidence = aggregates.top_ids(lines.select(F.col("l_suppkey").alias("vendor"), "l_extendedprice", "l_orderkey", "l_partkey"), ["vendor"], order, "l_orderkey", 5)
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vendor"), F.col("s_name").alias("name"))
    # at most 200 vendors have a share of 0.005, so the rank is over few rows
    rank = F.row_number().over(Window.orderBy(F.desc("spend"), "vendor")).cast("long")
    return shared.join(evidence, "vendor").join(names, "vendor").select(
        "vendor", "name", "spend", F.round("share", 6).alias("share"), F.when(F.col("share") >= 0.40, "high").otherwise("medium").alias("severity"), rank.alias("rank"), "evidence"
    )


@query("SELECT o_custkey AS entity, count(*) AS awards, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 HAVING count(*) >= 3")
def repeat_awards(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"))
    return o.agg(F.count("*").alias("awards"), F.round(F.sum("o_totalprice"), 2).alias("total")).filter("awards >= 3")


@query("""
SELECT CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, count(*) AS awards, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS entities FROM orders GROUP BY 1
""")
def fiscal_year_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(values.fiscal_year(F.col("o_orderdate")).alias("fiscal_year"))
    return o.agg(F.count("*").alias("awards"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.count_distinct("o_custkey").alias("entities"))


@query("""
WITH g AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_orderkey) AS awards,
  string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS statuses, year(min(o_orderdate)) AS lo, year(max(o_orderdate)) AS hi FROM orders GROUP BY 1),
p AS (SELECT o_custkey, string_agg(x, '|' ORDER BY x) AS priorities FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY x) AS k FROM (SELECT DISTINCT o_custkey, o_orderpriority AS x FROM orders)) WHERE k <= 3 GROUP BY 1)
SELECT g.o_custkey AS entity, first_priority, total, awards, statuses, priorities, CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END AS years FROM g JOIN p ON g.o_custkey = p.o_custkey
""")
def entity_master(spark, sf_dir):
    """One row per entity with firsts, sums, sets and year range."""
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count_distinct("o_orderkey").alias("awards"),
        aggregates.set_text("o_orderstatus").alias("statuses"),
        aggregates.set_text("o_orderpriority", 3).alias("priorities"),
        F.year(F.min("o_orderdate")).alias("lo"),
        F.year(F.max("o_orderdate")).alias("hi"),
    )
    return g.withColumn("years", values.year_range(F.col("lo"), F.col("hi"))).drop("lo", "hi")


@query("""
SELECT user_id, string_agg(event_type, '|' ORDER BY t, event_type) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS t FROM events GROUP BY 1, 2) GROUP BY 1
""")
def first_seen_sets(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(aggregates.order_text("event_type", "event_id").alias("kinds"))


@query("""
SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS outlays, round(sum(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END), 2) AS obligations,
  round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) / sum(l_extendedprice), 4) AS rate FROM lineitem GROUP BY 1
""")
def pivot_flag_sum(spark, sf_dir):
    out = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0))
    rest = F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).otherwise(0))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(out, 2).alias("outlays"), F.round(rest, 2).alias("obligations"), F.round(out / F.sum("l_extendedprice"), 4).alias("rate"))


@query("""
SELECT coalesce('brand:' || p_brand, 'type:' || p_type, 'size:' || p_size) AS bucket, count(*) AS n, CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS total_cents FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), (p_size))
""")
def coverage_matrices(spark, sf_dir):
    """Single-column groupings in one pass."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size", "p_retailprice")
    g = p.groupingSets([[F.col("p_brand")], [F.col("p_type")], [F.col("p_size")]], "p_brand", "p_type", "p_size")
    bucket = F.coalesce(F.concat(F.lit("brand:"), "p_brand"), F.concat(F.lit("type:"), "p_type"), F.concat(F.lit("size:"), F.col("p_size").cast("string")))
    return g.agg(F.count("*").alias("n"), F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("total_cents")).select(bucket.alias("bucket"), "n", "total_cents")


@query("""
SELECT c_nationkey AS place, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 4) AS share FROM customer WHERE c_nationkey % 5 > 0 GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM customer) >= 0.03
""")
def geo_cluster(spark, sf_dir):
    """Share of a place in all rows; blank places count in the denominator only."""
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_nationkey") % 5 > 0, F.col("c_nationkey")).alias("place"))
    n = aggregates.with_share(c.groupBy("place").agg(F.count("*").alias("n")), "n")
    return n.filter("place IS NOT NULL AND share >= 0.03").select("place", "n", F.round("share", 4).alias("share"))


@query("""
SELECT l_suppkey, l_partkey % 7 AS kind, n FROM (SELECT l_suppkey, l_partkey % 7 AS l_partkey, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey % 7) AS k FROM lineitem GROUP BY l_suppkey, l_partkey % 7) WHERE k = 1
""")
def mode_top(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 7).alias("kind"))
    return aggregates.mode(rows, ["l_suppkey"], "kind")


@query("""
WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS x FROM lineitem GROUP BY 1), v AS (SELECT o_orderkey, o_totalprice AS rep, coalesce(x, 0) AS summed FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
SELECT o_orderkey, round(summed, 2) AS summed, round(summed - rep, 2) AS variance, CASE WHEN rep <> 0 AND abs((summed - rep) / rep * 100) >= 10 THEN 'FAIL'
  WHEN (rep <> 0 AND abs((summed - rep) / rep * 100) >= 1) OR abs(summed - rep) >= 10000 THEN 'WARN' ELSE 'OK' END AS status FROM v
""")
def reconcile_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    r = aggregates.reconcile(o, lines, "o_orderkey", "o_totalprice", "l_extendedprice")
    return r.select("o_orderkey", F.round("summed", 2).alias("summed"), F.round("variance", 2).alias("variance"), "status")


@query("""
SELECT l.l_orderkey, l.l_linenumber, l_returnflag, l_suppkey, n_values FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1) k ON l.l_orderkey = k.l_orderkey AND l.l_linenumber = k.l_linenumber
""")
def contradictions(spark, sf_dir):
    claims = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    return aggregates.contradictions(claims, ["l_orderkey", "l_linenumber"], "l_returnflag")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
t AS (SELECT CAST(sum(least(coalesce(a.n, 0), coalesce(b.n, 0))) AS BIGINT) AS common, CAST(sum(coalesce(a.n, 0)) AS BIGINT) AS left_rows, CAST(sum(coalesce(b.n, 0)) AS BIGINT) AS right_rows FROM a FULL JOIN b ON a.k = b.k)
SELECT *, round(common / (left_rows + right_rows - common), 6) AS jaccard, round(common / greatest(left_rows, right_rows), 6) AS of_larger FROM t
""")
def set_overlap(spark, sf_dir):
    """Nations of all customers against those of all suppliers."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return aggregates.multiset_overlap(c.select(F.col("c_nationkey").alias("nation")), s.select(F.col("s_nationkey").alias("nation")), ["nation"])


@query("""
WITH c AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END AS segment, c_acctbal AS balance FROM customer)
SELECT 'name' AS field, count(*) AS n_rows, count(*) FILTER (WHERE trim(coalesce(name, '')) <> '') AS filled, round(count(*) FILTER (WHERE trim(coalesce(name, '')) <> '') / count(*), 4) AS rate FROM c
UNION ALL SELECT 'segment', count(*), count(*) FILTER (WHERE trim(coalesce(segment, '')) <> ''), round(count(*) FILTER (WHERE trim(coalesce(segment, '')) <> '') / count(*), 4) FROM c
UNION ALL SELECT 'balance', count(*), count(balance), round(count(balance) / count(*), 4) FROM c
""")
def completeness(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(F.when(k % 4 != 0, F.col("c_name")).alias("name"), F.when(k % 3 == 0, " ").otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance"))
    return aggregates.filled_rates(c, ["name", "segment", "balance"])


@query("""
WITH o AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS awards, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT c_custkey AS entity, coalesce(awards, 0) AS awards, coalesce(n, 0) AS filings, greatest(c_acctbal, 0) AS giving FROM customer LEFT JOIN o ON k = c_custkey),
m AS (SELECT entity, (awards - min(awards) OVER ()) / (max(awards) OVER () - min(awards) OVER ()) * 100 AS a, CAST(filings - min(filings) OVER () AS DOUBLE) / (max(filings) OVER () - min(filings) OVER ()) * 100 AS f,
  (giving - min(giving) OVER ()) / (max(giving) OVER () - min(giving) OVER ()) * 100 AS g, CAST(awards > 0 AS INTEGER) + CAST(filings > 0 AS INTEGER) + CAST(giving > 0 AS INTEGER) AS axes FROM c)
SELECT entity, round(0.5 * a + 0.2 * f + 0.15 * g + 0.15 * (axes / 3 * 100), 2) AS score, axes = 3 AS full_loop FROM m
""")
def minmax_influence(spark, sf_dir):
    """Weighted axes on 0 to 100 and the number of axes present."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity")).agg(F.round(F.sum("o_totalprice"), 2).alias("awards"), F.count("*").alias("filings"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.greatest("c_acctbal", F.lit(0.0)).alias("giving"))
    axes = c.join(o, "entity", "left").fillna(0, ["awards", "filings"])
    n = aggregates.min_max_100(axes, ["awards", "filings", "giving"])
    present = sum((F.col(x) > 0).cast("int") for x in ("awards", "filings", "giving"))
    score = 0.5 * F.col("awards_norm") + 0.2 * F.col("filings_norm") + 0.15 * F.col("giving_norm") + 0.15 * (present / 3 * 100)
    return n.select("entity", F.round(score, 2).alias("score"), (present == 3).alias("full_loop"))


@query("""
WITH a AS (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS old_rank FROM supplier), t AS (SELECT l_suppkey AS k, round(sum(l_extendedprice), 2) AS x FROM lineitem GROUP BY 1),
b AS (SELECT k, row_number() OVER (ORDER BY x DESC, k) AS new_rank FROM t)
SELECT b.k AS vendor, new_rank, old_rank, old_rank - new_rank AS delta FROM b JOIN a ON a.k = b.k
""")
def rank_delta(spark, sf_dir):
    old = products.ranked(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("vendor"), F.col("s_acctbal").alias("x")), "x", "vendor", "old_rank")
    spend = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("vendor")).agg(F.round(F.sum("l_extendedprice"), 2).alias("x"))
    new = products.ranked(spend, "x", "vendor", "new_rank")
    return new.join(old.select("vendor", "old_rank"), "vendor").select("vendor", "new_rank", "old_rank", (F.col("old_rank") - F.col("new_rank")).alias("delta"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""")
def top_control(spark, sf_dir):
    """The 25 largest, ties by key."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""
SELECT o_orderkey, o_orderstatus, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997) AS total FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997 ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40
""")
def page_of_rows(spark, sf_dir):
    """A page of a filtered listing, with its total."""
    o = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & F.col("o_orderdate").between("1997-01-01", "1997-12-31 23:59:59"))
    return products.page(o, [F.col("o_orderdate"), F.col("o_orderkey")], 40, 20).select("o_orderkey", "o_orderstatus", "total")


@query("""
SELECT 'line_part' AS "constraint", CAST(l_partkey AS VARCHAR) AS key, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT CASE WHEN p_partkey % 50 = 0 THEN -1 - p_partkey ELSE p_partkey END FROM part) GROUP BY 2
UNION ALL SELECT 'order_customer', CAST(o_custkey AS VARCHAR), count(*) FROM orders WHERE o_custkey NOT IN (SELECT CASE WHEN c_custkey % 40 = 0 THEN -1 - c_custkey ELSE c_custkey END FROM customer) GROUP BY 2
""")
def fk_orphans(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("p_partkey", lost_key("p_partkey", 50))
    c = table(spark, sf_dir, "customer").withColumn("c_custkey", lost_key("c_custkey", 40))
    return checks.orphans(table(spark, sf_dir, "lineitem"), p, "l_partkey", "p_partkey", "line_part").unionByName(
        checks.orphans(table(spark, sf_dir, "orders"), c, "o_custkey", "c_custkey", "order_customer")
    )


@query("""
WITH c AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS priority FROM orders)
SELECT 'status' AS field, round(avg(CASE WHEN status IS NULL THEN 1 ELSE 0 END), 6) AS null_rate, CAST(0.05 AS DOUBLE) AS max_rate, avg(CASE WHEN status IS NULL THEN 1 ELSE 0 END) <= 0.05 AS ok FROM c
UNION ALL SELECT 'priority', round(avg(CASE WHEN trim(priority) = '' THEN 1 ELSE 0 END), 6), 0.3, avg(CASE WHEN trim(priority) = '' THEN 1 ELSE 0 END) <= 0.3 FROM c
""")
def null_rates(spark, sf_dir):
    k = F.col("o_orderkey")
    c = table(spark, sf_dir, "orders").select(F.when(k % 10 != 0, F.col("o_orderstatus")).alias("status"), F.when(k % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"))
    return checks.null_gate(c, {"status": 0.05, "priority": 0.3})


@query("""
WITH a AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey, c_mktsegment, c_acctbal FROM customer),
  b AS (SELECT CASE WHEN c_custkey % 6 = 0 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN a.c_custkey IS NULL THEN 'insert' WHEN b.c_custkey IS NULL THEN 'missing'
  WHEN a.c_mktsegment IS NOT DISTINCT FROM b.c_mktsegment AND a.c_acctbal IS NOT DISTINCT FROM b.c_acctbal THEN 'unchanged' ELSE 'update' END AS action FROM a FULL JOIN b ON a.c_custkey = b.c_custkey
""")
def upsert_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = c.withColumns({"c_custkey": lost_key("c_custkey", 6), "c_mktsegment": F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))})
    return checks.upsert_plan(c.withColumn("c_custkey", lost_key("c_custkey", 5)), new, ["c_custkey"], ["c_mktsegment", "c_acctbal"])


@query("""
WITH h AS (SELECT conv_id, turn, sha256(role || '|' || text) AS payload_hash FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
p AS (SELECT *, lag(payload_hash) OVER (PARTITION BY conv_id ORDER BY turn) AS true_previous, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM h)
SELECT conv_id, turn, CASE WHEN (CASE WHEN turn = 2 AND conv_id % 3 = 0 THEN 'x' ELSE true_previous END) IS DISTINCT FROM true_previous THEN 'hash' ELSE 'sequence' END AS fault
FROM p WHERE (turn = 2 AND conv_id % 3 = 0) OR turn <> before + 1
""")
def hash_chain(spark, sf_dir):
    """An audit chain with tampered links, and the rows that show it."""
    log = checks.chain(table(spark, sf_dir, "conversations").distinct(), "conv_id", "turn", F.concat_ws("|", "role", "text"))
    bad = (F.col("turn") == 2) & (F.col("conv_id") % 3 == 0)
    log = log.withColumn("previous_hash", F.when(bad, "x").otherwise(F.col("previous_hash")))
    return checks.chain_faults(log, "conv_id", "turn").select("conv_id", "turn", "fault")


@query("""
WITH g AS (SELECT n_nationkey, r_regionkey FROM nation, region WHERE n_regionkey = r_regionkey), a AS (SELECT s_nationkey AS n_nationkey, s_nationkey % 3 AS r_regionkey, count(*) AS n FROM supplier GROUP BY 1, 2)
SELECT coalesce(g.n_nationkey, a.n_nationkey) AS n_nationkey, coalesce(g.r_regionkey, a.r_regionkey) AS r_regionkey, CASE WHEN a.n IS NULL THEN 'missing' WHEN g.n_nationkey IS NULL THEN 'extra' ELSE 'duplicate' END AS state
FROM g FULL JOIN a ON g.n_nationkey = a.n_nationkey AND g.r_regionkey = a.r_regionkey WHERE a.n IS NULL OR g.n_nationkey IS NULL OR a.n > 1
""")
def shard_completeness(spark, sf_dir):
    """Receipts against the grid that should be there."""
    grid = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    got = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), (F.col("s_nationkey") % 3).alias("r_regionkey"))
    return checks.grid_gaps(grid, got, ["n_nationkey", "r_regionkey"])


@query("""
WITH v AS (SELECT avg(CASE WHEN l_orderkey IN (SELECT CASE WHEN o_orderkey % 20 = 0 THEN -1 - o_orderkey ELSE o_orderkey END FROM orders) THEN 1.0 ELSE 0 END) AS linked, 1 - count(DISTINCT (l_orderkey, l_linenumber)) / count(*) AS dup FROM lineitem)
SELECT 'linked' AS gate, round(linked, 4) AS value, CAST(0.9 AS DOUBLE) AS threshold, linked >= 0.9 AS passed FROM v UNION ALL SELECT 'dup', round(dup, 4), 0.05, dup <= 0.05 FROM v
""")
def production_gates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    known = table(spark, sf_dir, "orders").select(lost_key("o_orderkey", 20).alias("l_orderkey"), F.lit(1.0).alias("hit"))
    # an order's lines are told apart where they lie; parts of so many lines that memory stays as it is whatever the table
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + lines.count() // _LINES)
    lines, known = lines.repartition(parts, "l_orderkey"), known.repartition(parts, "l_orderkey")
    v = lines.join(known.hint("merge"), "l_orderkey", "left").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("linked"), (1 - F.count_distinct("l_orderkey", "l_linenumber") / F.count("*")).alias("dup"))
    return checks.gates(v, [("linked", ">=", 0.9), ("dup", "<=", 0.05)])


@query("""
WITH s AS (SELECT n_nationkey AS place, n_name AS name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) AS vendors, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS grantees FROM nation)
SELECT place, name, vendors, grantees, CASE WHEN vendors > 0 THEN 60 ELSE 0 END + CASE WHEN grantees > 0 THEN 40 ELSE 0 END AS score, CASE WHEN vendors = 0 AND grantees = 0 THEN 'no data' WHEN vendors = 0 THEN 'no vendors' WHEN grantees = 0 THEN 'no grantees' ELSE '' END AS blind_spot FROM s
""")
def universe_matrix(spark, sf_dir):
    """Every place of the dimension appears, with what it lacks."""
    dim = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("name"))
    s = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("place")).agg(F.count("*").alias("vendors"))
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.count("*").alias("grantees"))
    m = dim.join(s, "place", "left").join(c, "place", "left").fillna(0, ["vendors", "grantees"])
    v, g = F.col("vendors") > 0, F.col("grantees") > 0
    spot = F.when(~v & ~g, "no data").when(~v, "no vendors").when(~g, "no grantees").otherwise("")
    return m.select("place", "name", "vendors", "grantees", scores.additive([(v, 60), (g, 40)]).cast("int").alias("score"), spot.alias("blind_spot"))


@query("""
SELECT count(*) AS n_rows, (SELECT count(DISTINCT o_custkey) FROM orders) AS entities FROM orders
""")
def manifest_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.agg(F.count("*").alias("n_rows"), F.count_distinct("o_custkey").alias("entities"))
