"""Queries on rule sets and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import edges
from .registry import query, table


@query("""
SELECT p_partkey, upper(p_name) AS vendor, CASE WHEN p_partkey % 5 = 0 THEN 'debris' WHEN p_partkey % 5 = 1 THEN 'roads_bridges' WHEN p_partkey % 5 = 2 THEN 'utilities' WHEN p_partkey % 5 = 3 THEN 'parks_rec' ELSE 'other' END AS asset,
  CASE p_size % 5 WHEN 3 THEN 'restricted_charity' WHEN 4 THEN 'likely_political' ELSE 'other' END AS bucket,
  CASE WHEN p_partkey % 4 = 0 THEN 'PASS' WHEN p_partkey % 4 = 1 THEN 'FAIL' ELSE 'UNRESOLVED' END AS identity FROM part
""")
def rule_classes(spark, sf_dir):
    """Vendor names, asset classes, tax subsections and identity adjudication."""
    k = F.col("p_partkey")
    said = F.element_at(F.array(*[F.lit(x) for x in ("Cat. A work", "Bridge 7", "Wastewater line", "Playground", "misc")]), (k % 5 + 1).cast("int"))
    uei = F.when(k % 4 < 2, "U1").otherwise("")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        rules.vendor_name(F.concat("p_name", F.lit(", Contractors & Consultants Inc."))).alias("vendor"),
        rules.asset_class(said, F.lit(None).cast("string")).alias("asset"),
        rules.tax_subsection(F.concat(F.lit("c-"), (F.col("p_size") % 5).cast("string"))).alias("bucket"),
        rules.adjudicate(uei, F.when(k % 4 == 1, "U2").otherwise("U1")).alias("identity"),
    )


@query("""
SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'outside_foreign' WHEN 1 THEN 'outside_state' WHEN 2 THEN CASE WHEN c_nationkey < 20 THEN 'code_exact' ELSE 'invalid_code' END WHEN 3 THEN 'outside_county' WHEN 4 THEN 'parser_failed' WHEN 5 THEN 'name_normalized' WHEN 6 THEN 'ambiguous' ELSE 'missing' END AS reason FROM customer
""")
def geo_reasons(spark, sf_dir):
    """Why a row has the place it has."""
    k, n = F.col("c_custkey") % 8, F.lpad(F.col("c_nationkey").cast("string"), 3, "0")
    code = F.when(k == 2, F.concat(F.lit("72"), n)).when(k == 3, "36061").when(k == 4, "n/k").otherwise("")
    reason = rules.place_reason(
        F.when(k == 0, "España").otherwise("usa"),
        F.when(k == 1, "NY").otherwise("Puerto Rico"),
        F.lit(""),
        code,
        (k == 2) & (F.col("c_nationkey") < 20),
        F.when(k.isin(5, 6), "Ponce").otherwise(" "),
        k == 5,
    )
    return table(spark, sf_dir, "customer").select("c_custkey", reason.alias("reason"))


@query("""
WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), h AS (SELECT doc_id, t, CAST(contains(t, 'the ') AS INTEGER) + CAST(contains(t, ' and ') AS INTEGER) AS en, CAST(contains(t, 'der ') AS INTEGER) + CAST(contains(t, ' und ') AS INTEGER) AS de FROM t)
SELECT doc_id, concat_ws('|', CASE WHEN en >= 1 THEN 'english' END, CASE WHEN de >= 1 THEN 'german' END) AS names, CASE WHEN contains(t, '###') THEN 'reject' WHEN greatest(en, de) >= 2 THEN 'accept' WHEN greatest(en, de) >= 1 THEN 'review' ELSE 'reject' END AS decision FROM h
""")
def scored_categories(spark, sf_dir):
    """Categories by hits against two limits, with words that rule a text out."""
    c = rules.categories(F.col("text"), {"english": ("the ", " and "), "german": ("der ", " und ")}, 2, 1, ("###",))
    d = table(spark, sf_dir, "documents").select("doc_id", c.alias("c"))
    return d.select("doc_id", F.array_join("c.names", "|").alias("names"), "c.decision")


_ROWS = """i AS (SELECT CASE WHEN n_nationkey % 6 = 0 THEN 'OLD_' ELSE '' END || n_name AS name, min(CAST(n_nationkey AS VARCHAR)) AS node FROM nation GROUP BY 1), r AS (SELECT c_custkey, 'NATION_' || c_nationkey AS source, CASE WHEN c_custkey % 10 = 0 THEN 'likes' ELSE 'funds' END AS verb, 'NATION_' || (c_custkey % 25) AS target,
  CASE WHEN c_custkey % 17 = 0 THEN ' ' ELSE 'row ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS evidence, (c_custkey % 10) / 10.0 AS confidence FROM customer),
m AS (SELECT r.*, a.node AS src, b.node AS dst, CASE WHEN verb <> 'funds' THEN 'bad_verb' WHEN trim(evidence) = '' THEN 'no_evidence' WHEN a.node IS NULL THEN 'unresolved_source' WHEN b.node IS NULL THEN 'unresolved_target' WHEN a.node = b.node THEN 'self_loop' END AS reason FROM r LEFT JOIN i a ON source = a.name LEFT JOIN i b ON target = b.name)"""


def _rows(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("n_name", F.concat(F.when(F.col("n_nationkey") % 6 == 0, "OLD_").otherwise(""), "n_name"))
    index = edges.name_index([(n, "n_nationkey", F.array("n_name"))])
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("source"),
        F.when(k % 10 == 0, "likes").otherwise("funds").alias("verb"),
        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("target"),
        F.when(k % 17 == 0, " ").otherwise(F.concat(F.lit("row "), F.lpad(k.cast("string"), 9, "0"))).alias("evidence"),
        ((k % 10) / 10).alias("confidence"),
    )
    return edges.build(rows, index, ["funds"])


@query(f"WITH {_ROWS} SELECT 'edge_' || substr(sha256(src || '|' || verb || '|' || dst), 1, 16) AS edge_id, src, verb, dst, count(*) AS weight, CAST(max(confidence) AS DOUBLE) AS confidence, min(evidence) AS evidence, max(confidence) < 0.8 AS review FROM m WHERE reason IS NULL GROUP BY src, verb, dst")
def edge_build(spark, sf_dir):
    """Edges between resolved ends with evidence."""
    return _rows(spark, sf_dir)[0]


@query(f"WITH {_ROWS} SELECT reason, count(*) AS n FROM m WHERE reason IS NOT NULL GROUP BY 1")
def edge_skips(spark, sf_dir):
    """What didn't become an edge, by reason."""
    return _rows(spark, sf_dir)[1].groupBy("reason").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT s_nationkey % 5 AS a, c_nationkey % 5 AS b, count(*) AS w FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT 'R' || a AS src, 'R' || b AS dst, CAST(w AS BIGINT) AS weight FROM e WHERE a <> b
""")
def parent_overlay(spark, sf_dir):
    """Flows between nations lifted to their regions."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("src"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("dst"))
    e = lines.join(o, "l_orderkey").join(s, "l_suppkey").join(c, "o_custkey").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    p = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("R"), (F.col("n_nationkey") % 5).cast("string")).alias("parent"))
    return edges.overlay(e, p)


@query("""
WITH d AS (SELECT DISTINCT c_nationkey AS k, 'customer' AS d FROM customer UNION SELECT DISTINCT s_nationkey, 'supplier' FROM supplier UNION SELECT n_nationkey, 'nation' FROM nation)
SELECT k AS subject, string_agg(d, '|' ORDER BY d) AS domains FROM d GROUP BY k HAVING count(*) > 1
""")
def cross_layers(spark, sf_dir):
    """cross_layers over whole tables."""
    named = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("k"))
    frames = {"customer": named("customer", "c_nationkey"), "supplier": named("supplier", "s_nationkey"), "nation": named("nation", "n_nationkey")}
    return edges.domains_of(frames, "k").withColumn("domains", F.array_join("domains", "|"))


@query("""
WITH s AS (SELECT n_nationkey, count(s_suppkey) AS r FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1)
SELECT n_nationkey, CASE WHEN n_nationkey % 9 = 8 THEN 'missing' WHEN n_nationkey % 9 = 7 THEN 'fixture' WHEN r = 0 THEN 'empty' WHEN r < 4 THEN 'below_minimum' ELSE 'materialised' END AS state,
  concat_ws('|', CASE WHEN r < 4 THEN 'rows' END, CASE WHEN n_nationkey % 3 > 0 THEN 'source' END) AS missing FROM s
""")
def dataset_states(spark, sf_dir):
    """State of each dataset and the gates it misses."""
    k = F.col("n_nationkey")
    r = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("r"))
    s = table(spark, sf_dir, "nation").select("n_nationkey").join(r, "n_nationkey", "left").fillna(0, ["r"])
    states = F.create_map(F.lit("rows"), F.col("r") >= 4, F.lit("source"), k % 3 == 0)
    return s.select("n_nationkey", rules.materialisation(k % 9 != 8, F.col("r"), 4, k % 9 == 7).alias("state"), F.array_join(rules.missing_gates(states, ["source", "rows"]), "|").alias("missing"))
