"""Holdings that managers report each quarter: observations, restated rows and restated filings.

submissions: ACCESSION_NUMBER, CIK, SUBMISSIONTYPE, PERIODOFREPORT, FILING_DATE.
covers: ACCESSION_NUMBER, ISAMENDMENT, AMENDMENTTYPE, FILINGMANAGER_NAME.
summaries: ACCESSION_NUMBER, TABLEVALUETOTAL.  entries: ACCESSION_NUMBER, INFOTABLE_SK, CUSIP,
TITLEOFCLASS, VALUE, SSHPRNAMT, SSHPRNAMTTYPE, PUTCALL, INVESTMENTDISCRETION, OTHERMANAGER.
All columns may be texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values
from ..operators import linkage

# What amendments call themselves.
RESTATEMENTS = ("RESTATEMENT", "RESTATED")
ADDITIONS = ("NEW HOLDINGS", "NEW HOLDING", "ADDITION", "ADDITIONAL HOLDINGS")
DATES = ("dd-MMM-yyyy", "yyyy-MM-dd")
# Columns that say that two rows are about the same position.
POSITION = ("holder_id", "issuer_id", "security_id", "security_class", "as_of", "put_call", "discretion", "other_manager")


def _said(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def _number(df: DataFrame, c: str) -> Column:
    """The column as a number; what is a number already isn't written out and read again."""
    if dict(df.dtypes)[c] in ("double", "float", "int", "bigint"):
        n = F.col(c).cast("double")
        return F.when(~F.isnan(n), n)
    return values.number(F.replace(_said(c), F.lit(","), F.lit("")))


def _needed(found: Column, ok: Column, what: str) -> Column:
    """The value; a filing without it raises, since no holder or period could be told."""
    return F.when(ok, found).otherwise(F.raise_error(F.concat(F.col("accession"), F.lit(f": no readable {what}"))).cast("string"))


def _day(c: str, what: str) -> Column:
    return _needed(F.col(c).cast("string"), F.col(c).isNotNull(), what).cast("date")


def unjoined(entries: DataFrame, submissions: DataFrame, covers: DataFrame, summaries: DataFrame) -> DataFrame:
    """accession, lacks: filings with entries that one of the other tables doesn't know."""
    out = entries.select(_said("ACCESSION_NUMBER").alias("accession")).distinct()
    names = []
    for name, df in (("submission", submissions), ("cover", covers), ("summary", summaries)):
        known = df.select(_said("ACCESSION_NUMBER").alias("accession")).distinct().withColumn(f"_{name}", F.lit(name))
        out = out.join(known, "accession", "left")
        names.append(F.when(F.col(f"_{name}").isNull(), name))
    return out.select("accession", F.concat_ws(",", *names).alias("lacks")).filter("lacks <> ''")


def observations(entries: DataFrame, submissions: DataFrame, covers: DataFrame, summaries: DataFrame, issuers: DataFrame) -> DataFrame:
    """One row for each entry whose filing all three tables know (``unjoined`` lists the others); issuers: cusip, issuer.

    An amendment is an addition, or unknown until ``restated_rows`` has found what it restates.
    A filing without a CIK, a period or a filing date raises.
    """
    key = _said("ACCESSION_NUMBER").alias("accession")
    s = submissions.select(key, "CIK", "SUBMISSIONTYPE", "PERIODOFREPORT", "FILING_DATE")
    c = covers.select(key, "ISAMENDMENT", "AMENDMENTTYPE", "FILINGMANAGER_NAME")
    t = summaries.select(key, _number(summaries, "TABLEVALUETOTAL").alias("_total"))
    amended = F.upper(_said("ISAMENDMENT")).isin("Y", "YES", "1", "TRUE") | F.upper(_said("SUBMISSIONTYPE")).endswith("/A")
    raw = F.upper(_said("AMENDMENTTYPE"))
    kind = F.when(~amended, "ORIGINAL").when(raw.isin(*ADDITIONS), "AMENDED_ADDITION").otherwise("UNKNOWN")
    # read once for each filing; what can't be read raises where an entry needs it
    filings = s.join(c, "accession").join(t, "accession").select(
        "accession", F.regexp_replace(_said("CIK"), "[^0-9]", "").alias("_cik"), _said("FILINGMANAGER_NAME").alias("_manager"), values.date_of(_said("PERIODOFREPORT"), DATES).alias("_as_of"),
        values.date_of(_said("FILING_DATE"), DATES).alias("_filed"), "_total", kind.alias("_kind"), F.when(amended, raw).otherwise("ORIGINAL").alias("_type"),
    )
    cusip = F.upper(_said("CUSIP"))
    rows = entries.withColumn("accession", key).drop("ACCESSION_NUMBER").join(filings, "accession").withColumn("_cusip", cusip)
    rows = rows.join(issuers.select(F.upper(_said("cusip")).alias("_cusip"), F.col("issuer").cast("string").alias("_issuer")), "_cusip", "left")
    holder = F.concat(F.lit("INV_CIK_"), F.lpad("_cik", 10, "0"))
    unit, value, amount = F.upper(_said("SSHPRNAMTTYPE")), _number(entries, "VALUE"), _number(entries, "SSHPRNAMT")
    return rows.select(
        F.concat_ws(":", "accession", _said("INFOTABLE_SK")).alias("record"), "accession",
        _needed(holder, F.col("_cik") != "", "CIK").alias("holder_id"), F.col("_manager").alias("manager"),
        F.coalesce("_issuer", F.concat(F.lit("ISSUER_UNRESOLVED_CUSIP_"), cusip)).alias("issuer_id"),
        F.when(F.col("_issuer").isNull(), "UNRESOLVED").otherwise("PASS").alias("identity"), F.concat(F.lit("CUSIP:"), cusip).alias("security_id"),
        _said("TITLEOFCLASS").alias("security_class"), _day("_as_of", "PERIODOFREPORT").alias("as_of"), _day("_filed", "FILING_DATE").alias("filed"),
        F.when(unit == "SH", amount).alias("shares"), F.when(unit == "PRN", amount).alias("principal"), value.alias("value"),
        F.round(value / F.nullif("_total", F.lit(0.0)) * 100, 6).alias("percent_of_filing"), F.col("_kind").alias("amendment"), F.col("_type").alias("amendment_type"),
        _said("PUTCALL").alias("put_call"), _said("INVESTMENTDISCRETION").alias("discretion"), _said("OTHERMANAGER").alias("other_manager"),
    )


def is_restatement() -> Column:
    return F.col("amendment_type").isin(*RESTATEMENTS)


def restated_rows(df: DataFrame) -> DataFrame:
    """Adds ``restates``, and ``issue`` where a restatement has no single row of the latest earlier day to restate."""
    found = linkage.restated(df, list(POSITION), "filed", "record")
    sure = is_restatement() & F.col("restates").isNotNull()
    issue = F.when(is_restatement() & F.col("restates").isNull(), "restatement target is not uniquely proven")
    return found.withColumns({
        "restates": F.when(is_restatement(), F.col("restates")), "issue": issue, "amendment": F.when(sure, "AMENDED_RESTATEMENT").otherwise(F.col("amendment")),
    })


def active(df: DataFrame) -> DataFrame:
    """Adds ``superseded``: a later restatement by the same holder for the same period replaces all earlier filings."""
    return linkage.superseded(df, ["holder_id", "as_of"], "filed", "accession", is_restatement())


def lineages(df: DataFrame) -> DataFrame:
    """Each restating filing with the filings and numbers of rows before it, which it replaces, and its state."""
    one = df.groupBy("holder_id", "as_of", "accession").agg(F.min("filed").alias("filed"), F.max(is_restatement()).alias("_is"), F.count("*").alias("entries"))
    before = Window.partitionBy("holder_id", "as_of").orderBy("filed", "accession").rowsBetween(Window.unboundedPreceding, -1)
    each = one.withColumns({"prior_filings": F.count("*").over(before), "replaced_rows": F.coalesce(F.sum("entries").over(before), F.lit(0)), "prior": F.lag("accession").over(Window.partitionBy("holder_id", "as_of").orderBy("filed", "accession"))})
    state = F.when(F.col("prior_filings") > 0, "PRIOR_RETAINED_FILING_SUPERSEDED").otherwise("NO_PRIOR_TARGET_ROWS_RETAINED")
    return each.filter("_is").select("holder_id", "as_of", "accession", "entries", "prior", "prior_filings", "replaced_rows", state.alias("state"))
