"""The graph of influence as queries: every table stands for one kind of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import influence
from .registry import query, table

_TIERS = {"awards": "observed", "chains": "linked", "lda": "observed", "fec": "linked", "bonds": "observed", "ngo_funding": "observed"}

_ARCS = """ent AS (SELECT c_custkey AS n, CASE WHEN c_custkey % 3 = 0 THEN 'U' || c_custkey ELSE '' END AS u, CASE WHEN c_custkey % 3 = 1 THEN c_name ELSE '' END AS m, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'GROUP ' || c_nationkey END AS parent FROM customer),
aw AS (SELECT o_orderkey AS n, 'AGENCY ' || o_orderpriority AS agency, c_name AS who, CASE WHEN c_custkey % 4 = 0 THEN 'HOLD ' || c_nationkey ELSE coalesce(a.parent, b.parent, '') END AS parent, n_name AS place, o_totalprice AS x, CAST(o_orderkey AS VARCHAR) AS ev
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN ent a ON a.u = 'U' || c_custkey LEFT JOIN ent b ON b.m = c_name AND b.m <> ''),
ch AS (SELECT l_orderkey * 100 + l_linenumber AS n, c_name AS prime, CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE s_name END AS sub, CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'ASSET ' || l_partkey END AS asset, CASE WHEN l_linenumber = 1 THEN '' ELSE n_name END AS place,
  CASE WHEN l_returnflag = 'N' THEN 0.5 ELSE round(1 - 4 * l_discount, 2) END AS c, CAST(l_orderkey AS VARCHAR) AS ev, l_extendedprice AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
ng AS (SELECT p_partkey AS n, p_brand AS funder, 'NGO ' || p_size AS ngo, p_type AS name, 'NATION_' || p_partkey % 25 AS place, CASE WHEN p_size % 7 = 0 THEN 0.45 ELSE least(0.95, p_size * 2 / 100) END AS c, 'P' || p_partkey AS ev, p_retailprice AS x FROM part),
arc AS (SELECT 0 AS t, n, 0 AS j, agency AS source, who AS target, 'awards_to' AS verb, x AS weight, ev AS evidence, 0.75 AS c, 'agency' AS st, 'prime' AS tt, 'awards' AS dataset, 'observed' AS tier FROM aw
 UNION ALL SELECT 0, n, 1, parent, who, 'parent_of', 1, ev, 0.9, 'parent_entity', 'prime', 'awards', 'observed' FROM aw
 UNION ALL SELECT 0, n, 2, who, place, 'located_in', 1, ev, 0.6, 'prime', 'municipality', 'awards', 'observed' FROM aw
 UNION ALL SELECT 1, n, 0, prime, sub, 'subawards_to', x, ev, c, 'prime', 'subcontractor', 'chains', 'linked' FROM ch
 UNION ALL SELECT 1, n, 1, coalesce(nullif(sub, ''), prime), asset, 'executes_project', x, ev, c, 'subcontractor', 'asset', 'chains', 'linked' FROM ch
 UNION ALL SELECT 1, n, 2, coalesce(nullif(asset, ''), nullif(sub, ''), prime), place, 'located_in', 1, ev, 0.6, 'asset', 'municipality', 'chains', 'linked' FROM ch
 UNION ALL SELECT 2, event_id, 0, 'REGISTRANT ' || event_type, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0'), 'lobbies_for', CASE WHEN event_id % 5 = 0 OR value = 0 THEN 1 ELSE value END, 'E' || event_id, 0.65, 'lobbying_registrant', 'lobbying_client', 'lda', 'observed' FROM events
 UNION ALL SELECT 3, c_custkey, 0, c_name, c_mktsegment, 'contributes_to', CASE WHEN c_acctbal = 0 THEN 1 ELSE c_acctbal END, 'T' || c_custkey, 0.55, 'person_or_entity', 'campaign_committee', 'fec', 'linked' FROM customer
 UNION ALL SELECT 4, s_suppkey, 0, s_name, CASE WHEN s_nationkey % 10 = 0 THEN '' ELSE 'DEALER ' || s_nationkey END, 'underwrites', s_acctbal, 'B' || s_suppkey, 0.8, 'bond_issuer', 'underwriter', 'bonds', 'observed' FROM supplier
 UNION ALL SELECT 4, s_suppkey, 1, s_name, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'ASSET ' || s_suppkey END, 'funds_asset', s_acctbal, 'B' || s_suppkey, 0.65, 'bond_issuer', 'asset', 'bonds', 'observed' FROM supplier
 UNION ALL SELECT 5, n, 0, funder, ngo, 'funds_ngo', x, ev, c, 'agency', 'ngo', 'ngo_funding', 'observed' FROM ng
 UNION ALL SELECT 5, n, 1, ngo, place, 'located_in', 1, ev, 0.6, 'ngo', 'municipality', 'ngo_funding', 'observed' FROM ng
 UNION ALL SELECT 6, n, 0, ngo, 'ASSET ' || n, 'executes_project', 1, 'ASSET ' || n, 0, 'ngo', 'asset', 'ngo_asset', 'blocked' FROM ng
 UNION ALL SELECT 6, n, 1, 'ASSET ' || n, CASE WHEN n % 3 = 0 THEN '' ELSE place END, 'located_in', 1, 'ASSET ' || n, 0.6, 'asset', 'municipality', 'ngo_asset', 'blocked' FROM ng
 UNION ALL SELECT 7, n_nationkey, 0, 'NGO ' || n_nationkey, 'NGO ' || (n_nationkey + 25), 'fiscal_sponsor_of', 1, '', 0.8, 'ngo', 'ngo', 'ngo_sponsor', 'blocked' FROM nation),
e AS (SELECT t, n, j, source, target, verb, CAST(round(weight, 2) AS DOUBLE) AS weight, evidence, CAST(round(c, 3) AS DOUBLE) AS confidence, c < 0.8 AS review, dataset, tier, st, tt FROM arc WHERE source <> '' AND target <> ''),
nd AS (SELECT node, arg_min({'l': label, 't': type}, (t, n, j, side, label, type)) AS f FROM (SELECT source AS node, source AS label, st AS type, t, n, j, 0 AS side FROM e UNION ALL SELECT target, target, tt, t, n, j, 1 FROM e UNION ALL SELECT ngo, name, 'ngo', 5, n, -1, 0 FROM ng WHERE trim(name) <> '') GROUP BY 1),
mt AS (SELECT node, count(*) AS degree, round(sum(weight), 2) AS weighted_degree, round(sum(CASE WHEN verb IN ('awards_to', 'subawards_to', 'underwrites', 'funds_asset') THEN weight ELSE 0 END), 2) AS contract_weight, count(*) FILTER (review) AS review_edges,
  ['observed', 'linked', 'blocked'][max(list_position(['observed', 'linked', 'blocked'], tier))] AS tier FROM (SELECT source AS node, verb, weight, review, tier FROM e UNION ALL SELECT target, verb, weight, review, tier FROM e) GROUP BY 1)"""


def _tagged(word: str, c: str | Column) -> Column:
    return F.concat(F.lit(word), (F.col(c) if isinstance(c, str) else c).cast("string"))


def _tables(spark, sf_dir) -> list[tuple[str, str, DataFrame, str]]:
    c, o, li, s, p, n, e = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "supplier", "part", "nation", "events"))
    key = F.col("c_custkey")
    entities = c.select(
        key.alias("n"), F.when(key % 3 == 0, _tagged("U", "c_custkey")).alias("entity_uei"), F.when(key % 3 == 1, F.col("c_name")).alias("normalized_name"),
        F.when(key % 5 != 0, _tagged("GROUP ", "c_nationkey")).alias("parent_name"),
    )
    awards = o.join(c, F.col("o_custkey") == key).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_orderkey").alias("n"), _tagged("AGENCY ", "o_orderpriority").alias("awarding_agency"), F.col("c_name").alias("recipient_name"), _tagged("U", "c_custkey").alias("recipient_uei"),
        F.when(key % 4 == 0, _tagged("HOLD ", "c_nationkey")).alias("parent_uei"), F.col("n_name").alias("municipality"), F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("award_id"),
    )
    buyers = o.join(c, F.col("o_custkey") == key).select(F.col("o_orderkey").alias("l_orderkey"), F.col("c_name").alias("prime_name"))
    sellers = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name")
    chains = li.join(buyers, "l_orderkey").join(sellers, "l_suppkey").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("n"), "prime_name", F.when(F.col("l_suppkey") % 6 != 0, F.col("s_name")).alias("sub_name"),
        F.when(F.col("l_partkey") % 4 != 0, _tagged("ASSET ", "l_partkey")).alias("asset_id"), F.when(F.col("l_linenumber") != 1, F.col("n_name")).alias("county"),
        F.when(F.col("l_returnflag") != "N", F.round(1 - 4 * F.col("l_discount"), 2)).alias("link_confidence"), F.col("l_orderkey").alias("award_id"), F.col("l_extendedprice").alias("subaward_amount"),
    )
    lobbying = e.select(F.col("event_id").alias("n"), _tagged("REGISTRANT ", "event_type").alias("registrant"), _tagged("Customer#", F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("client"), _tagged("E", "event_id").alias("filing_id"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("amount"))
    gifts = c.select(key.alias("n"), F.col("c_name").alias("donor"), F.col("c_mktsegment").alias("committee"), _tagged("T", "c_custkey").alias("transaction_id"), F.col("c_acctbal").alias("amount"))
    bonds = s.select(F.col("s_suppkey").alias("n"), F.col("s_name").alias("issuer"), F.when(F.col("s_nationkey") % 10 != 0, _tagged("DEALER ", "s_nationkey")).alias("dealer"), _tagged("B", "s_suppkey").alias("cusip"), F.col("s_acctbal").alias("amount"), F.when(F.col("s_suppkey") % 2 != 0, _tagged("ASSET ", "s_suppkey")).alias("project_asset"))
    ngo, place = _tagged("NGO ", "p_size"), _tagged("NATION_", F.col("p_partkey") % 25)
    rating = F.when(F.col("p_size") % 7 == 0, "high").otherwise((F.col("p_size") * 2).cast("string"))
    funding = p.select(F.col("p_partkey").alias("n"), F.col("p_brand").alias("source_entity"), ngo.alias("target_ngo_id"), F.col("p_type").alias("target_name"), place.alias("municipality"), rating.alias("confidence"), _tagged("P", "p_partkey").alias("award_id"), F.col("p_retailprice").alias("amount"))
    holdings = p.select(F.col("p_partkey").alias("n"), ngo.alias("ngo_id"), _tagged("ASSET ", "p_partkey").alias("asset_id"), F.when(F.col("p_partkey") % 3 != 0, place).alias("municipality"))
    sponsors = n.select(F.col("n_nationkey").alias("n"), _tagged("NGO ", "n_nationkey").alias("sponsor_ngo_id"), _tagged("NGO ", F.col("n_nationkey") + 25).alias("sponsored_entity"), F.lit("80").alias("confidence"))
    return [
        ("award", "awards", influence.with_parent(awards, entities, "n"), "n"), ("chain", "chains", chains, "n"), ("lobbying", "lda", lobbying, "n"), ("contribution", "fec", gifts, "n"),
        ("bond", "bonds", bonds, "n"), ("ngo_funding", "ngo_funding", funding, "n"), ("ngo_asset", "ngo_asset", holdings, "n"), ("ngo_sponsor", "ngo_sponsor", sponsors, "n"),
    ]


def _arcs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return influence.arcs(_tables(spark, sf_dir), _TIERS)


def _metrics(spark, sf_dir) -> DataFrame:
    return influence.nodes_measured(*_arcs(spark, sf_dir))


@query(f"WITH {_ARCS} SELECT source, target, verb, weight, dataset, evidence, confidence, tier, review FROM e")
def influence_edges(spark, sf_dir):
    """Typed arcs of eight kinds of rows."""
    return _arcs(spark, sf_dir)[0].select("source", "target", "verb", "weight", "dataset", "evidence", "confidence", "tier", "review")


@query(f"WITH {_ARCS} SELECT node, f.l AS label, f.t AS node_type FROM nd")
def influence_nodes(spark, sf_dir):
    return influence.nodes(*_arcs(spark, sf_dir))


@query(f"WITH {_ARCS} SELECT mt.*, f.t AS node_type FROM mt JOIN nd USING (node)")
def influence_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query(f"WITH {_ARCS} SELECT mt.*, f.t AS node_type FROM mt JOIN nd USING (node) ORDER BY contract_weight DESC, node LIMIT 25")
def influence_top(spark, sf_dir):
    """The 25 nodes with most contract money."""
    return influence.top_control(_metrics(spark, sf_dir))
