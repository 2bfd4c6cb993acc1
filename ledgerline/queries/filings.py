"""Replacement chains, filing denominators and strong components as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import graph
from ..plans import filings
from .registry import query, table

_FILINGS = """f AS (
  SELECT o_orderkey AS filing, o_orderdate AS at, o_orderdate + CASE WHEN o_orderkey % 90 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS reported,
    CASE WHEN o_orderkey % 77 <> 0 THEN o_orderpriority END AS form, o_custkey % 199 AS holder,
    CASE WHEN o_custkey % 199 <> 7 AND o_orderstatus = 'P' THEN NULL
      WHEN o_orderpriority = '1-URGENT' THEN lag(o_orderkey, 2) OVER w
      ELSE coalesce(lag(o_orderkey) OVER w, CASE WHEN o_custkey % 199 = 7 THEN last_value(o_orderkey) OVER w END) END AS replaces
  FROM orders WINDOW w AS (PARTITION BY o_custkey % 199 ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)"""
_CHAINS = f"""WITH RECURSIVE {_FILINGS},
nxt AS (SELECT n.filing AS node, max_by(f.filing, struct_pack(a := f.at, i := f.filing)) AS next, count(DISTINCT f.filing) AS rivals
  FROM f n LEFT JOIN f ON f.replaces = n.filing GROUP BY n.filing),
ends(node, last, hops) AS (
  SELECT node, node, 0 FROM nxt WHERE next IS NULL UNION ALL SELECT n.node, e.last, e.hops + 1 FROM nxt n JOIN ends e ON n.next = e.node
), round(start, node) AS (
  SELECT n.node, n.next FROM nxt n WHERE n.node NOT IN (SELECT node FROM ends) UNION SELECT r.start, n.next FROM round r JOIN nxt n ON n.node = r.node
), cyc AS (
  SELECT r.start AS node, min(r.node) AS cycle FROM round r WHERE r.node IN (SELECT start FROM round WHERE start = node) GROUP BY r.start
), chained AS (
  SELECT n.node AS filing, last, hops, cycle, rivals FROM nxt n LEFT JOIN ends e ON e.node = n.node LEFT JOIN cyc c ON c.node = n.node
)"""


def _filings(spark, sf_dir):
    """Orders as filings of holders: each replaces the one before, some the one before that, some none; one holder's go in a circle."""
    o = table(spark, sf_dir, "orders")
    w = Window.partitionBy("holder").orderBy("o_orderdate", "o_orderkey")
    last = F.last("o_orderkey").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.lag("o_orderkey").over(w), F.when(F.col("holder") == 7, last))
    replaces = F.when(~((F.col("holder") != 7) & (F.col("o_orderstatus") == "P")), F.when(F.col("o_orderpriority") == "1-URGENT", F.lag("o_orderkey", 2).over(w)).otherwise(before))
    o = o.withColumn("holder", F.col("o_custkey") % 199)
    late = F.when(F.col("o_orderkey") % 90 == 0, 1).otherwise(0)
    return o.select(
        F.col("o_orderkey").alias("filing"),
        F.col("o_orderdate").alias("at"),
        (F.col("o_orderdate") + F.make_dt_interval(late)).alias("reported"),
        F.when(F.col("o_orderkey") % 77 != 0, F.col("o_orderpriority")).alias("form"),
        "holder",
        replaces.alias("replaces"),
    )


@query(f"{_CHAINS} SELECT filing, last, CAST(hops AS BIGINT) AS hops, cycle, rivals FROM chained")
def filing_chains(spark, sf_dir):
    """What replaced each filing in the end, over chains of any length, and circles."""
    return filings.replacements(_filings(spark, sf_dir), "filing", "replaces", ["at"])


@query(f"""{_CHAINS}, said AS (
  SELECT f.filing, f.holder, f.at, last, CAST(hops AS BIGINT) AS hops, CASE WHEN form IS NULL THEN 'MISSING_FIELD' WHEN f.at < f.reported THEN 'FILED_BEFORE_PERIOD' WHEN form = '5-LOW' THEN 'FORM_TYPE_OUT_OF_SCOPE'
    WHEN cycle IS NOT NULL THEN 'REPLACEMENT_CYCLE' WHEN rivals > 1 THEN 'REPLACEMENT_CONFLICT' WHEN hops > 0 THEN 'SUPERSEDED' END AS reason
  FROM f JOIN chained USING (filing))
SELECT filing, CASE WHEN reason IS NULL THEN 'retained' ELSE 'excluded' END AS state, reason, last, hops,
  CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY holder, reason IS NULL ORDER BY said.at, filing) END AS place FROM said""")
def filing_denominator(spark, sf_dir):
    """Which filings count, in order, and what each of the others is left out for."""
    f = _filings(spark, sf_dir)
    out = filings.denominator(f, "filing", "replaces", "at", "reported", ["form"], F.col("form") != "5-LOW")
    return filings.placed(out, ["holder"], "at", "filing").select("filing", "state", "reason", "last", "hops", F.col("place").cast("long").alias("place"))


_NEXT = """ends AS (SELECT o_custkey AS src, max(o_orderkey) AS a, min(o_orderkey) AS b FROM orders GROUP BY 1),
e AS (SELECT DISTINCT src, o_custkey AS dst FROM ends JOIN orders ON o_orderkey = a + 1 OR o_orderkey = b + 1)"""


def _followers(spark, sf_dir):
    """From each customer to those whose orders come right after its first and its last one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ends = o.groupBy(F.col("o_custkey").alias("src")).agg(F.array(F.max("o_orderkey") + 1, F.min("o_orderkey") + 1).alias("both"))
    each = ends.select("src", F.explode("both").alias("o_orderkey"))
    return each.join(o, "o_orderkey").select("src", F.col("o_custkey").alias("dst")).distinct()


@query(f"""WITH RECURSIVE {_NEXT}, r(src, dst) AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON e.src = r.dst)
SELECT a.src AS node, min(least(a.src, a.dst)) AS component FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src GROUP BY 1""")
def cycle_components(spark, sf_dir):
    """The customers that lie on cycles, by strong component."""
    return graph.strong_components(_followers(spark, sf_dir))
