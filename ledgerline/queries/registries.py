"""Registries and rule sets as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import registry
from .registry import query, table


@query("""
WITH e AS (
  SELECT 'base' AS layer, concat('S', s_suppkey) AS source_id, unnest(['title', 'cadence', 'required']) AS field,
    unnest([s_name, CASE s_suppkey % 3 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' ELSE 'yearly' END, CAST(s_suppkey % 2 = 0 AS VARCHAR)]) AS value FROM supplier
  UNION ALL SELECT 'extension', concat('N', n_nationkey), unnest(['title', 'required']), unnest([n_name, 'false']) FROM nation
  UNION ALL SELECT 'override', concat('S', s_suppkey), unnest(['cadence', 'note']), unnest(['manual', CAST(s_nationkey AS VARCHAR)]) FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT 'override', concat('N', n_nationkey), 'title', concat(n_name, ' renamed') FROM nation WHERE n_regionkey = 1
)
SELECT source_id, field, value, layer FROM e QUALIFY row_number() OVER (PARTITION BY source_id, field ORDER BY CASE layer WHEN 'override' THEN 0 WHEN 'extension' THEN 1 ELSE 2 END) = 1
""")
def registry_fields(spark, sf_dir):
    """Suppliers and nations as sources: each field from the layer that has the last word."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")

    def layer(df, name, source, **fields):
        pairs = F.array(*[F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items()])
        return df.select(F.lit(name).alias("layer"), F.concat_ws("#", F.lit(name), source).alias("place"), source.alias("source_id"), F.inline(pairs))

    sid, nid = F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    cadence = F.element_at(F.array(F.lit("daily"), F.lit("weekly"), F.lit("yearly")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    entries = (
        layer(s, "base", sid, title=F.col("s_name"), cadence=cadence, required=F.col("s_suppkey") % 2 == 0)
        .unionByName(layer(n, "extension", nid, title=F.col("n_name"), required=F.lit(False)))
        .unionByName(layer(s.filter("s_acctbal < 0"), "override", sid, cadence=F.lit("manual"), note=F.col("s_nationkey")))
        .unionByName(layer(n.filter("n_regionkey = 1"), "override", nid, title=F.concat("n_name", F.lit(" renamed"))))
    )
    return registry.merged(entries)
