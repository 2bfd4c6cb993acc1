"""Risk signals and the scores made of them, as queries.

Awards are orders; customers of some numbers belong to two holdings, so that one
recipient has almost half of all awards.  Chains are order lines.  Suppliers, parts
and events stand for three kinds of filings, customers for issuers of bonds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import union_all
from ..plans import products, risk
from ..sources import interim
from .registry import query, table

_AWARDS = """aw AS (SELECT o_orderkey AS id, CASE WHEN c_custkey % 20 < 9 THEN 'Prime Holding, LLC' WHEN c_custkey % 20 < 13 THEN 'Second Builders Inc' ELSE c_name END AS who, o_totalprice AS x,
  CASE WHEN n_nationkey = 24 THEN '' WHEN n_regionkey < 2 THEN 'SAN JUAN' ELSE n_name END AS place, c_nationkey AS home,
  o_orderkey % 10 = 0 AS no_path, o_orderpriority = '5-LOW' AS no_set, o_orderkey % 15 = 0 AS no_record
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
chn AS (SELECT l_orderkey || '-' || l_linenumber AS chain_id, who AS prime, s_name AS sub, l_suppkey % 7 = 0 AS no_uei, round(1 - 4 * l_discount, 2) AS link, l_returnflag = 'A' AS waits,
  home % 5 > 0 AND home = s_nationkey AS related, home, l_extendedprice AS amount FROM lineitem JOIN aw ON l_orderkey = id JOIN supplier ON l_suppkey = s_suppkey)"""

_BARE = "trim(replace(replace(replace(replace(upper({0}), ' LLC', ''), ' INC', ''), ' CORP', ''), ' S.E.', ''))"

_SIGNALS = f"""{_AWARDS},
tot AS (SELECT sum(x) AS x, count(*) AS n FROM aw),
r AS (SELECT who, sum(x) AS x, count(*) AS n, array_to_string(list_slice(list(id ORDER BY id), 1, 15), ';') AS ids FROM aw GROUP BY 1),
pl AS (SELECT place, count(*) AS n, array_to_string(list_slice(list(id ORDER BY id), 1, 10), ';') AS ids FROM aw WHERE place <> '' GROUP BY 1),
pw AS (SELECT place, array_to_string(list_slice(list(who ORDER BY n DESC, who), 1, 2), ', ') AS top FROM (SELECT place, who, count(*) AS n FROM aw GROUP BY 1, 2) GROUP BY 1),
kn AS (SELECT {_BARE.format("who")} AS subject, array_to_string(list_slice(list(id ORDER BY id), 1, 5), ';') AS ids FROM aw GROUP BY 1),
fl AS (SELECT 'lda' AS tag, 'lobbying_client_is_awardee' AS kind, 'medium' AS severity, 0.8 AS confidence, 'customer#' || substr(s_name, 10) || ' LLC' AS client, 'F' || s_suppkey AS record, 'N' || s_nationkey AS by_whom, 1.0 AS v FROM supplier
 UNION ALL SELECT 'cabilderos', 'pr_lobbying_client_is_awardee', 'medium', 0.8, 'Customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || ' S.E.', p_brand, p_brand, 1.0 FROM part
 UNION ALL SELECT 'fec', 'fec_contributor_employer_is_awardee', 'low', 0.6, ' Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' Inc', 'E' || event_id, event_type, value FROM events),
bd AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'PRIME HOLDING,' ELSE c_name || '  Corp' END AS issuer, 'B' || c_custkey AS cusip, c_acctbal AS par FROM customer),
op AS (SELECT *, concat_ws(', ', CASE WHEN no_uei THEN 'missing_sub_uei' END, CASE WHEN link < 0.8 THEN 'low_link_confidence:' || printf('%.2f', link) END, CASE WHEN waits THEN 'manual_review_required' END) AS flags FROM chn),
ln AS (SELECT *, concat_ws(', ', CASE WHEN no_path THEN 'source_lineage_path' END, CASE WHEN no_set THEN 'source_dataset' END, CASE WHEN no_record THEN 'source_record_id' END) AS missing, CAST(no_path AS INT) + CAST(no_set AS INT) + CAST(no_record AS INT) AS n FROM aw),
bare AS (SELECT 'concentration' AS family, 'entity_award_concentration' AS kind, CASE WHEN r.x / tot.x >= 0.4 THEN 'high' ELSE 'medium' END AS severity, 'entity' AS subject_type, {_BARE.format("who")} AS subject, who AS entity,
  round(r.x / tot.x, 6) AS value, 0.15 AS threshold, 0.9 AS confidence, ids AS evidence, who || ' received ' || printf('%.1f', round(r.x / tot.x * 100, 1)) || '% of all award money (' || format('{{:,}}', CAST(round(r.x) AS BIGINT)) || ' of ' || format('{{:,}}', CAST(round(tot.x) AS BIGINT)) || ')' AS explanation FROM r, tot WHERE r.x / tot.x >= 0.15
 UNION ALL SELECT 'repeat_awards', 'repeat_award_recipient', 'medium', 'entity', {_BARE.format("who")}, who, n, 3, 0.85, ids, who || ' received ' || n || ' awards' FROM r WHERE n >= 3
 UNION ALL SELECT 'subaward_opacity', 'chain_opacity', CASE WHEN no_uei THEN 'high' ELSE 'medium' END, 'chain', chain_id, prime, link, 0.8, greatest(0.1, link), chain_id, 'chain ' || chain_id || ' (' || prime || ' to ' || sub || '): ' || flags FROM op WHERE flags <> ''
 UNION ALL SELECT 'parent_sub_mismatch', 'shared_corporate_parent', 'high', 'chain', chain_id, prime, 1, 0, 0.95, chain_id, prime || ' and ' || sub || ' share the parent P' || home FROM chn WHERE related
 UNION ALL SELECT 'political_overlap', kind, severity, 'entity', subject, client, v, 0, confidence, tag || ':' || record || ';awards:' || ids, client || ' is in ' || tag || ' (' || by_whom || ') and received awards' FROM fl JOIN kn ON {_BARE.format("client")} = subject
 UNION ALL SELECT 'bond_contract_overlap', 'bond_issuer_is_contract_recipient', 'medium', 'entity', subject, issuer, par, 0, 0.85, 'emma:' || cusip || ';awards:' || ids, issuer || ' issued bond ' || cusip || ' (' || format('{{:,}}', CAST(round(par) AS BIGINT)) || ' par) and received awards' FROM bd JOIN kn ON {_BARE.format("issuer")} = subject
 UNION ALL SELECT 'geographic_clustering', 'municipality_award_concentration', 'medium', 'municipality', place, place, round(pl.n / tot.n, 6), 0.3, 0.8, ids, place || ' has ' || printf('%.1f', round(pl.n / tot.n * 100, 1)) || '% of the awards (' || pl.n || ' of ' || tot.n || '), most to ' || top FROM pl JOIN pw USING (place), tot WHERE pl.n / tot.n >= 0.3
 UNION ALL SELECT 'stale_lineage', 'missing_lineage_fields', 'low', 'award', CAST(id AS VARCHAR), who, n, 0, 0.7, CAST(id AS VARCHAR), 'award ' || id || ' lacks ' || missing FROM ln WHERE n > 0),
sig AS (SELECT 'SIG-' || upper(substr(family, 1, 4)) || '-' || substr(sha256(kind || '|' || subject || '|' || evidence), 1, 16) AS signal_id, family, kind, severity, subject_type, subject, entity, CAST(value AS DOUBLE) AS value, CAST(threshold AS DOUBLE) AS threshold, CAST(confidence AS DOUBLE) AS confidence, evidence, explanation FROM bare)"""

_WEIGHTS = """w AS (SELECT *, CASE family WHEN 'concentration' THEN 1.0 WHEN 'repeat_awards' THEN 0.7 WHEN 'subaward_opacity' THEN 0.8 WHEN 'parent_sub_mismatch' THEN 1.0 WHEN 'political_overlap' THEN 0.6 WHEN 'bond_contract_overlap' THEN 0.5 WHEN 'geographic_clustering' THEN 0.4 ELSE 0.3 END AS f,
  CASE severity WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.6 ELSE 0.3 END AS s,
  list_position(['concentration', 'repeat_awards', 'subaward_opacity', 'parent_sub_mismatch', 'political_overlap', 'bond_contract_overlap'], family) AS place FROM sig)"""


def _awards(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    holding = F.when(F.col("c_custkey") % 20 < 9, "Prime Holding, LLC").when(F.col("c_custkey") % 20 < 13, "Second Builders Inc").otherwise(F.col("c_name"))
    return rows.select(
        F.col("o_orderkey").alias("award_id"), holding.alias("recipient"), F.col("o_totalprice").alias("amount"), F.col("c_nationkey").alias("home"),
        F.when(F.col("n_nationkey") == 24, "").when(F.col("n_regionkey") < 2, "SAN JUAN").otherwise(F.col("n_name")).alias("place"),
        F.when(F.col("o_orderkey") % 10 == 0, " ").otherwise("orders").alias("source_lineage_path"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("source_dataset"),
        F.when(F.col("o_orderkey") % 15 != 0, F.col("o_orderkey").cast("string")).otherwise("").alias("source_record_id"),
    )


def _chains(spark, sf_dir, awards: DataFrame) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    rows = table(spark, sf_dir, "lineitem").join(awards, F.col("l_orderkey") == F.col("award_id")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    parent = lambda c: F.concat(F.lit("P"), F.col(c).cast("string"))
    return rows.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("chain_id"), F.col("award_id"),
        F.col("recipient").alias("prime_name"), F.col("s_name").alias("sub_name"), F.col("place"), F.col("l_extendedprice").alias("obligation"),
        F.when(F.col("l_suppkey") % 7 != 0, parent("l_suppkey")).alias("sub_uei"), F.round(1 - 4 * F.col("l_discount"), 2).alias("link_confidence"),
        F.when(F.col("l_returnflag") == "A", "Yes").otherwise("no").alias("manual_review"),
        F.when(F.col("home") % 5 > 0, parent("home")).otherwise("").alias("prime_parent"), parent("s_nationkey").alias("sub_parent"),
    )


def _filings(spark, sf_dir) -> dict[str, DataFrame]:
    number = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    named = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    s, p, e = (table(spark, sf_dir, t) for t in ("supplier", "part", "events"))
    return {
        "lda": s.select(F.concat(F.lit("customer#"), F.substring("s_name", 10, 100), F.lit(" LLC")).alias("client"), named("F", "s_suppkey").alias("record"), named("N", "s_nationkey").alias("by")),
        "cabilderos": p.select(F.concat(F.lit("Customer#"), number("p_partkey"), F.lit(" S.E.")).alias("client"), F.col("p_brand").alias("record"), F.col("p_brand").alias("by")),
        "fec": e.select(F.concat(F.lit(" Customer#"), number("user_id"), F.lit(" Inc")).alias("client"), named("E", "event_id").alias("record"), F.col("event_type").alias("by"), F.col("value").alias("amount")),
    }


def _bonds(spark, sf_dir) -> DataFrame:
    issuer = F.when(F.col("c_custkey") % 3 == 0, "PRIME HOLDING,").otherwise(F.concat("c_name", F.lit("  Corp")))
    return table(spark, sf_dir, "customer").select(issuer.alias("issuer"), F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("cusip"), F.col("c_acctbal").alias("par"))


def _signals(spark, sf_dir) -> DataFrame:
    awards = interim.settled(_awards(spark, sf_dir), "awards")  # seven detectors read it
    return risk.detect(awards, _chains(spark, sf_dir, awards), _filings(spark, sf_dir), _bonds(spark, sf_dir))


@query(f"WITH {_SIGNALS} SELECT * FROM sig")
def risk_signals(spark, sf_dir):
    """Eight families of detectors in one schema, with evidence and explanation."""
    return _signals(spark, sf_dir)


@query(f"WITH {_SIGNALS} SELECT family, count(*) AS signals, count(DISTINCT subject) AS subjects FROM sig GROUP BY 1")
def risk_families(spark, sf_dir):
    """Families that fired."""
    return risk.fired(_signals(spark, sf_dir))


@query(f"""WITH {_SIGNALS}, {_WEIGHTS}
SELECT subject, CAST(least(1, round(CAST(sum(f * s * confidence) / 8 AS DECIMAL(18, 9)), 4)) AS DOUBLE) AS score, count(*) AS n_signals, arg_min(family, (-f, family)) AS dominant_family,
  arg_min(entity, (place, entity)) AS entity, array_to_string(list_sort(list(DISTINCT family)), ';') AS families, CAST(round(CAST(avg(confidence) AS DECIMAL(18, 9)), 4) AS DOUBLE) AS confidence
FROM w WHERE subject_type IN ('entity', 'chain') GROUP BY subject""")
def entity_risk_scores(spark, sf_dir):
    return risk.entity_scores(_signals(spark, sf_dir))


@query(f"""WITH {_SIGNALS}, {_WEIGHTS}, k AS (SELECT subject, least(1, round(round(sum(f * s) / 3, 9), 4)) AS score, count(*) AS n, max(CASE WHEN family = 'subaward_opacity' THEN 1 ELSE 0 END) = 1 AS opaque FROM w WHERE subject_type = 'chain' GROUP BY 1)
SELECT chain_id, id AS award_id, prime AS prime_name, sub AS sub_name, place, amount AS obligation, link AS link_confidence, CAST(coalesce(score, 0) AS DOUBLE) AS score, coalesce(n, 0) AS n_signals, coalesce(opaque, false) AS opacity_flag
FROM (SELECT chn.*, aw.id, aw.place FROM chn JOIN aw ON CAST(split_part(chain_id, '-', 1) AS BIGINT) = aw.id) LEFT JOIN k ON subject = chain_id""")
def project_risk_scores(spark, sf_dir):
    """Every chain, also those without a signal."""
    awards = _awards(spark, sf_dir)
    chains = _chains(spark, sf_dir, awards)
    signals = union_all([risk.subaward_opacity(chains), risk.parent_sub_mismatch(chains)])
    return products.chain_scores(chains.drop("sub_uei", "manual_review", "prime_parent", "sub_parent"), signals, "chain_id")


@query(f"""WITH {_SIGNALS}, {_WEIGHTS}, k AS (SELECT subject, least(1, round(round(sum(f * s) / 2, 9), 4)) AS score, count(*) AS n FROM w WHERE subject_type = 'municipality' GROUP BY 1),
p AS (SELECT place, who, count(*) AS n, sum(x) AS x FROM aw WHERE place <> '' GROUP BY 1, 2),
a AS (SELECT place, CAST(sum(n) AS BIGINT) AS awards, round(sum(x), 2) AS total, arg_min(who, (-n, who)) AS top_recipient FROM p GROUP BY 1)
SELECT coalesce(place, subject) AS place, coalesce(awards, 0) AS awards, coalesce(total, 0) AS total, top_recipient, CAST(coalesce(score, 0) AS DOUBLE) AS score, coalesce(n, 0) AS n_signals FROM a FULL JOIN k ON place = subject""")
def municipality_risk_scores(spark, sf_dir):
    awards = _awards(spark, sf_dir)
    return products.place_scores(awards, risk.geographic_clustering(awards), "place", "amount", "recipient")
