"""Quarterly holdings as queries: orders are filings of fifty managers, order lines their entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import holdings
from .registry import query, table

_OBSERVED = """fil AS (SELECT CAST(o_orderkey AS VARCHAR) AS accession, 'INV_CIK_' || lpad(CAST(o_custkey % 50 AS VARCHAR), 10, '0') AS holder_id, last_day(CAST(o_orderdate AS DATE)) AS as_of, CAST(o_orderdate AS DATE) + CAST(45 + o_orderkey % 9 AS INTEGER) AS filed, o_totalprice AS total,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'RESTATEMENT' WHEN '2-HIGH' THEN 'NEW HOLDINGS' WHEN '3-MEDIUM' THEN '' ELSE 'ORIGINAL' END AS kind FROM orders WHERE o_orderkey % 41 <> 0),
obs AS (SELECT accession || ':' || l_linenumber || '-' || l_partkey AS record, accession, holder_id, 'Manager ' || holder_id[-2:] AS manager, coalesce(issuer, 'ISSUER_UNRESOLVED_CUSIP_C' || l_partkey % 9) AS issuer_id, CASE WHEN issuer IS NULL THEN 'UNRESOLVED' ELSE 'PASS' END AS identity,
  'CUSIP:C' || l_partkey % 9 AS security_id, 'COM' AS security_class, as_of, filed, CASE WHEN l_linestatus = 'O' THEN l_quantity END AS shares, CASE WHEN l_linestatus = 'F' THEN l_quantity END AS principal, l_extendedprice AS value,
  round(l_extendedprice / nullif(total, 0) * 100, 6) AS percent_of_filing, CASE kind WHEN 'NEW HOLDINGS' THEN 'AMENDED_ADDITION' WHEN 'ORIGINAL' THEN 'ORIGINAL' ELSE 'UNKNOWN' END AS amendment, kind AS amendment_type, CASE WHEN l_returnflag = 'A' THEN 'Put' ELSE '' END AS put_call, 'SOLE' AS discretion, '' AS other_manager
  FROM lineitem JOIN fil ON CAST(l_orderkey AS VARCHAR) = accession LEFT JOIN (SELECT 'C' || n_nationkey AS c, n_name AS issuer FROM nation WHERE n_nationkey % 3 > 0) ON c = 'C' || l_partkey % 9),
day AS (SELECT holder_id, issuer_id, security_id, security_class, as_of, put_call, discretion, other_manager, filed, min(record) AS r, count(*) AS n FROM obs GROUP BY ALL),
bef AS (SELECT *, lag(CASE WHEN n = 1 THEN r END) OVER (PARTITION BY holder_id, issuer_id, security_id, security_class, as_of, put_call, discretion, other_manager ORDER BY filed) AS found FROM day),
res AS (SELECT obs.* EXCLUDE (amendment), CASE WHEN amendment_type = 'RESTATEMENT' AND found IS NOT NULL THEN 'AMENDED_RESTATEMENT' ELSE amendment END AS amendment, CASE WHEN amendment_type = 'RESTATEMENT' THEN found END AS restates,
  CASE WHEN amendment_type = 'RESTATEMENT' AND found IS NULL THEN 'restatement target is not uniquely proven' END AS issue FROM obs JOIN bef USING (holder_id, issuer_id, security_id, security_class, as_of, put_call, discretion, other_manager, filed)),
f1 AS (SELECT holder_id, as_of, accession, min(filed) AS filed, max(amendment_type) = 'RESTATEMENT' AS again, count(*) AS entries FROM obs GROUP BY 1, 2, 3)"""


def _observed(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("ACCESSION_NUMBER", F.col("o_orderkey").cast("string"))
    known = o.filter(F.col("o_orderkey") % 41 != 0)  # the others have entries and no submission
    kind = F.col("o_orderpriority")
    filed = F.date_add(F.to_date("o_orderdate"), (45 + F.col("o_orderkey") % 9).cast("int"))
    submissions = known.select(
        "ACCESSION_NUMBER", (F.col("o_custkey") % 50).alias("CIK"), F.when(kind == "3-MEDIUM", "13F-HR/A").otherwise("13F-HR").alias("SUBMISSIONTYPE"),
        F.date_format(F.last_day("o_orderdate"), "dd-MMM-yyyy").alias("PERIODOFREPORT"), filed.cast("string").alias("FILING_DATE"),
    )
    covers = o.select(
        "ACCESSION_NUMBER", F.when(kind.isin("1-URGENT", "2-HIGH"), "y").alias("ISAMENDMENT"), F.when(kind == "1-URGENT", "Restatement").when(kind == "2-HIGH", " New Holdings").alias("AMENDMENTTYPE"),
        F.concat(F.lit("Manager "), F.lpad((F.col("o_custkey") % 50).cast("string"), 2, "0")).alias("FILINGMANAGER_NAME"),
    )
    summaries = o.select("ACCESSION_NUMBER", F.col("o_totalprice").alias("TABLEVALUETOTAL"))
    entries = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ACCESSION_NUMBER"), F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("INFOTABLE_SK"),
        F.concat(F.lit("c"), (F.col("l_partkey") % 9).cast("string")).alias("CUSIP"), F.lit(" COM").alias("TITLEOFCLASS"), F.col("l_extendedprice").alias("VALUE"), F.col("l_quantity").alias("SSHPRNAMT"),
        F.when(F.col("l_linestatus") == "O", "sh").otherwise("PRN").alias("SSHPRNAMTTYPE"), F.when(F.col("l_returnflag") == "A", "Put").alias("PUTCALL"), F.lit("SOLE").alias("INVESTMENTDISCRETION"), F.lit(None).cast("string").alias("OTHERMANAGER"),
    )
    issuers = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 3 > 0).select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("cusip"), F.col("n_name").alias("issuer"))
    return holdings.observations(entries, submissions, covers, summaries, issuers)


@query(f"WITH {_OBSERVED} SELECT * FROM res")
def holdings_restated(spark, sf_dir):
    """Entries of all filings; restatements bound to the one row that they restate."""
    return holdings.restated_rows(_observed(spark, sf_dir))


@query(f"WITH {_OBSERVED} SELECT record, value, coalesce((filed, accession) < (SELECT max((g.filed, g.accession)) FROM f1 g WHERE g.again AND g.holder_id = obs.holder_id AND g.as_of = obs.as_of), false) AS superseded FROM obs")
def holdings_active(spark, sf_dir):
    """Which rows a later restating filing replaces."""
    return holdings.active(_observed(spark, sf_dir)).select("record", "value", "superseded")


@query(f"""WITH {_OBSERVED}, w AS (SELECT *, lag(accession) OVER (PARTITION BY holder_id, as_of ORDER BY filed, accession) AS prior, row_number() OVER (PARTITION BY holder_id, as_of ORDER BY filed, accession) - 1 AS prior_filings,
  CAST(coalesce(sum(entries) OVER (PARTITION BY holder_id, as_of ORDER BY filed, accession ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS replaced_rows FROM f1)
SELECT holder_id, as_of, accession, entries, prior, prior_filings, replaced_rows, CASE WHEN prior_filings > 0 THEN 'PRIOR_RETAINED_FILING_SUPERSEDED' ELSE 'NO_PRIOR_TARGET_ROWS_RETAINED' END AS state FROM w WHERE again""")
def holdings_lineages(spark, sf_dir):
    """Restating filings and what they replace."""
    return holdings.lineages(_observed(spark, sf_dir))
