"""Entity resolution over customers and suppliers as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import resolution
from .registry import query, table

_RECORDS = """r AS (
  SELECT record, concat(seg, ' WORD', k % 211, ' XRAY', k % 13, ' GROUP') AS name,
    CASE WHEN k % 4 = 0 THEN [concat('BUILDING WORD', k % 211, ' XRAY', (k + 1) % 13, ' GROUP')] ELSE [] END AS aliases,
    concat('ST', k % 53, ' NO', k % 17) AS address, CASE WHEN k % 5 > 0 THEN concat('787', lpad(CAST(k % 331 AS VARCHAR), 7, '0')) END AS phone,
    list_distinct([concat('P', k % 97), concat('P', k % 89)]) AS officers, CASE WHEN k % 12 = 0 THEN concat('C', k // 10) END AS parent,
    [concat('K', k % 151)] AS contracts, CASE WHEN k % 3 = 0 THEN [concat('L', k % 61)] ELSE [] END AS clients,
    2000 + k % 10 AS valid_from, 2000 + k % 10 + k % 4 AS valid_to, k % 78 AS municipality, k % 30 AS project,
    CASE WHEN k % 2 = 0 THEN concat('U', k % 401) END AS uei, CASE WHEN k % 3 = 0 THEN concat('E', k % 211) END AS ein
  FROM (SELECT concat('C', c_custkey) AS record, c_custkey AS k, c_mktsegment AS seg FROM customer
    UNION ALL SELECT concat('S', s_suppkey), s_suppkey * 3, CASE WHEN s_nationkey % 2 = 0 THEN 'BUILDING' ELSE 'SUPPLY' END FROM supplier)
)"""
_PAIRS = f"""WITH {_RECORDS},
k AS (SELECT DISTINCT record, unnest(list_concat(
    [CASE WHEN uei IS NOT NULL THEN concat('id:uei=', uei) END, CASE WHEN ein IS NOT NULL THEN concat('id:ein=', ein) END, concat('name:', name),
      CASE WHEN phone IS NOT NULL THEN concat('phone:', phone) END, concat('address:', address)],
    list_transform(aliases, lambda x: concat('name:', x)),
    list_transform(list_filter(string_split(name, ' '), lambda x: length(x) >= 4), lambda x: concat('word:', x)))) AS key FROM r),
met AS (SELECT DISTINCT a.record AS a, b.record AS b FROM k a JOIN k b ON a.key = b.key AND a.record < b.record)"""


def _records(spark, sf_dir):
    """Customers and suppliers as records of entities, many of which share names, phones and identifiers."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("record"), F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    kind = F.when(F.col("s_nationkey") % 2 == 0, "BUILDING").otherwise("SUPPLY")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("record"), (F.col("s_suppkey") * 3).alias("k"), kind.alias("seg"))
    k = F.col("k")
    said = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    some = lambda when, *items: F.when(when, F.array(*items)).otherwise(F.array().cast("array<string>"))
    ids = F.map_filter(
        F.create_map(F.lit("uei"), F.when(k % 2 == 0, said("U", k % 401)), F.lit("ein"), F.when(k % 3 == 0, said("E", k % 211)), F.lit("vendor_id"), said("V", k % 7)),
        lambda _, v: v.isNotNull(),
    )
    return c.unionByName(s).select(
        "record",
        said(F.col("seg"), " WORD", k % 211, " XRAY", k % 13, " GROUP").alias("name"),
        some(k % 4 == 0, said("BUILDING WORD", k % 211, " XRAY", (k + 1) % 13, " GROUP")).alias("aliases"),
        said("ST", k % 53, " NO", k % 17).alias("address"),
        F.when(k % 5 > 0, F.concat(F.lit("787"), F.lpad((k % 331).cast("string"), 7, "0"))).alias("phone"),
        F.array_distinct(F.array(said("P", k % 97), said("P", k % 89))).alias("officers"),
        F.when(k % 12 == 0, said("C", F.floor(k / 10))).alias("parent"),
        F.array(said("K", k % 151)).alias("contracts"),
        some(k % 3 == 0, said("L", k % 61)).alias("clients"),
        (2000 + k % 10).alias("valid_from"),
        (2000 + k % 10 + k % 4).alias("valid_to"),
        (k % 78).alias("municipality"),
        (k % 30).alias("project"),
        ids.alias("ids"),
    )


@query(f"""{_PAIRS}, f AS (
  SELECT met.a, met.b, coalesce(x.uei = y.uei, false) OR coalesce(x.ein = y.ein, false) AS shares_id, coalesce(x.uei <> y.uei, false) OR coalesce(x.ein <> y.ein, false) AS disagrees,
    len(list_intersect(string_split(x.name, ' '), string_split(y.name, ' '))) / len(list_distinct(string_split(concat(x.name, ' ', y.name), ' '))) AS name,
    list_contains(y.aliases, x.name) OR list_contains(x.aliases, y.name) AS alias,
    len(list_intersect(string_split(x.address, ' '), string_split(y.address, ' '))) / len(list_distinct(string_split(concat(x.address, ' ', y.address), ' '))) AS address,
    len(list_intersect(x.officers, y.officers)) / least(len(x.officers), len(y.officers)) AS officer, coalesce(x.phone = y.phone, false) AS phone,
    coalesce(x.parent = met.b, false) OR coalesce(y.parent = met.a, false) AS parent, list_has_any(x.contracts, y.contracts) AS contract, list_has_any(x.clients, y.clients) AS lobby,
    x.municipality = y.municipality AND x.project = y.project AS municipality, x.valid_from <= y.valid_to AND y.valid_from <= x.valid_to AS temporal
  FROM met JOIN r x ON x.record = met.a JOIN r y ON y.record = met.b
), g AS (
  SELECT *, 0.60::DOUBLE * shares_id::INT + 0.18::DOUBLE * address + 0.18::DOUBLE * officer + 0.12::DOUBLE * phone::INT + 0.12::DOUBLE * parent::INT + 0.12::DOUBLE * contract::INT + 0.12::DOUBLE * lobby::INT
    + 0.12::DOUBLE * municipality::INT + 0.06::DOUBLE * temporal::INT AS other, 0.55::DOUBLE * name + 0.35::DOUBLE * alias::INT AS names FROM f
), h AS (SELECT *, round(CASE WHEN other > 0 THEN least(other + names, 1) ELSE least(other + names, 0.90::DOUBLE) END, 4) AS score FROM g)
SELECT a, b, score, CASE WHEN score >= 0.95 AND shares_id AND NOT disagrees THEN 'auto_merge' WHEN score >= 0.85 THEN 'suggested_merge' WHEN score >= 0.65 THEN 'possible_relationship'
  ELSE 'separate' END AS decision, shares_id, disagrees FROM h""")
def entity_decisions(spark, sf_dir):
    """All pairs of records that share a key, with the score of eleven features and what is to be done."""
    return resolution.decisions(_records(spark, sf_dir)).select("a", "b", "score", "decision", "shares_id", "disagrees")


@query()
def entity_merges(spark, sf_dir):
    """What each record is merged into; no entity holds two values of one identifier."""
    records = _records(spark, sf_dir)
    return resolution.merged(records, resolution.merging(records))[0]
