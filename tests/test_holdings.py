"""Archives read by member, and quarterly holdings with their restatements."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import holdings
from ledgerline.sources import archives

ENTRIES = "ACCESSION_NUMBER INFOTABLE_SK CUSIP TITLEOFCLASS VALUE SSHPRNAMT SSHPRNAMTTYPE PUTCALL INVESTMENTDISCRETION OTHERMANAGER"


def table(spark, columns, *rows):
    return spark.createDataFrame([tuple(r) + ("",) * (len(columns.split()) - len(r)) for r in rows], ", ".join(f"{c} string" for c in columns.split()))


@pytest.fixture(scope="module")
def member(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(archives.ArchiveMembers)

    def load(path, schema="ACCESSION_NUMBER string, CUSIP string, _line long", **more):
        return spark.read.format("archive_members").schema(schema).options(path=str(path), member="INFOTABLE.tsv", **more).load()

    return load


def write(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/") + ".tsv", text)


def test_members_of_many_archives(tmp_path, member):
    write(tmp_path / "a.zip", x__infotable="﻿cusip\tOTHER\t Accession_Number\r\nc1\tx\t a1 \r\n\r\nC2\n", README="no")
    write(tmp_path / "b.zip", INFOTABLE="ACCESSION_NUMBER\tCUSIP\nb1\t\"q\tq\"\n")
    df = member(tmp_path, upper="CUSIP")
    assert df.rdd.getNumPartitions() == 2
    assert sorted(tuple(r) for r in df.collect()) == [("", "C2", 2), ("a1", "C1", 1), ("b1", "Q\tQ", 1)]
    where = member(tmp_path / "b.zip", "_archive string, CUSIP string").head()
    assert where == (str(tmp_path / "b.zip"), "q\tq")


def test_identifiers_reach_the_reader(tmp_path, member, capfd):
    rows = "".join(f"a{i}\tc{i % 10}\n" for i in range(1000))
    write(tmp_path / "a.zip", INFOTABLE="ACCESSION_NUMBER\tCUSIP\n" + rows)
    df = member(tmp_path, upper="CUSIP").filter(F.col("CUSIP").isin("C3", "C4"))
    assert df.count() == 200 and df.filter("CUSIP = 'C4' AND ACCESSION_NUMBER LIKE 'a1_'").count() == 1
    df.explain()
    assert "Filter CUSIP" not in capfd.readouterr().out  # nothing is left for Spark to filter


def test_faults_of_archives_raise(tmp_path, member):
    write(tmp_path / "none.zip", OTHER="x")
    with pytest.raises(Exception, match="0 members named INFOTABLE.tsv"):
        member(tmp_path / "none.zip").count()
    write(tmp_path / "two.zip", a__INFOTABLE="x", b__INFOTABLE="x")
    with pytest.raises(Exception, match="2 members"):
        member(tmp_path / "two.zip").count()
    for name, text in (("lack.zip", "CUSIP\nx\n"), ("empty.zip", "")):
        write(tmp_path / name, INFOTABLE=text)
        with pytest.raises(Exception, match="lacks"):
            member(tmp_path / name).collect()


def test_keys_are_checked_on_all_rows(spark, tmp_path, member):
    write(tmp_path / "a.zip", INFOTABLE="ACCESSION_NUMBER\tCUSIP\na\tx\na\tx\nb\ty\n\tz\n")
    df = member(tmp_path)
    assert {(r.ACCESSION_NUMBER, r.fault) for r in archives.key_faults(df, ["ACCESSION_NUMBER"]).collect()} == {("a", "duplicate_key"), ("", "blank_key")}
    with pytest.raises(ValueError, match="duplicate_key.*'x'"):
        archives.require_keys(df.filter("ACCESSION_NUMBER <> ''"), ["ACCESSION_NUMBER", "CUSIP"])
    assert archives.require_keys(df, ["_line"]).count() == 4
    assert archives.key_faults(spark.createDataFrame([(None,), (None,)], "k string"), ["k"]).collect() == [(None, "blank_key")]


def observed(spark, filings, entries):
    """filings: accession, cik, period, filed, amended, amendment type; entries: accession, sk, cusip, value."""
    submissions = table(spark, "ACCESSION_NUMBER CIK SUBMISSIONTYPE PERIODOFREPORT FILING_DATE", *[(a, c, "13F-HR", p, f) for a, c, p, f, _, _ in filings])
    covers = table(spark, "ACCESSION_NUMBER ISAMENDMENT AMENDMENTTYPE FILINGMANAGER_NAME", *[(a, y, t, "M") for a, _, _, _, y, t in filings])
    summaries = table(spark, "ACCESSION_NUMBER TABLEVALUETOTAL", *[(a, "1,000") for a, *_ in filings])
    rows = table(spark, ENTRIES, *[(a, k, c, "COM", v, "5", "SH") for a, k, c, v in entries])
    issuers = table(spark, "cusip issuer", ("k1", "ISSUER"))
    return holdings.observations(rows, submissions, covers, summaries, issuers), holdings.unjoined(rows, submissions.filter("ACCESSION_NUMBER <> 'f1'"), covers, summaries)


FILINGS = [("f1", "7", "31-DEC-2023", "2024-02-01", "", ""), ("f2", "7", "2023-12-31", "2024-02-05", "Y", "restatement"), ("f3", "7", "2023-12-31", "05-FEB-2024", "Y", "NEW HOLDINGS"), ("f4", "8", "2023-12-31", "2024-02-05", "Y", "RESTATED"), ("f5", "7", "2024-03-31", "2024-05-01", "1", "odd")]


def test_observations(spark):
    rows, lacking = observed(spark, FILINGS, [("f1", "1", " k1", "250"), ("f5", "1", "k2", ""), ("f9", "1", "k1", "1")])
    got = [(r.record, r.holder_id, r.issuer_id, r.identity, str(r.as_of), r.shares, r.value, r.percent_of_filing, r.amendment) for r in rows.orderBy("record").collect()]
    assert got == [("f1:1", "INV_CIK_0000000007", "ISSUER", "PASS", "2023-12-31", 5.0, 250.0, 25.0, "ORIGINAL"), ("f5:1", "INV_CIK_0000000007", "ISSUER_UNRESOLVED_CUSIP_K2", "UNRESOLVED", "2024-03-31", 5.0, None, None, "UNKNOWN")]
    assert sorted(tuple(r) for r in lacking.collect()) == [("f1", "submission"), ("f9", "submission,cover,summary")]


@pytest.mark.parametrize("cik, day, what", [("x", "2023-12-31", "CIK"), ("7", "Q4", "PERIODOFREPORT")])
def test_filings_that_tell_no_holder_or_period_raise(spark, cik, day, what):
    rows, _ = observed(spark, [("f1", cik, day, "2024-02-01", "", "")], [("f1", "1", "k1", "1")])
    with pytest.raises(Exception, match=f"f1: no readable {what}"):
        rows.collect()


def test_a_row_restates_a_single_earlier_one(spark):
    rows, _ = observed(spark, FILINGS, [("f1", "1", "k1", "1"), ("f1", "2", "k2", "1"), ("f1", "3", "k2", "1"), ("f2", "1", "k1", "2"), ("f2", "2", "k2", "2"), ("f3", "1", "k1", "3"), ("f4", "1", "k1", "4")])
    got = {r.record: (r.restates, r.amendment, r.issue is not None) for r in holdings.restated_rows(rows).collect()}
    assert got["f2:1"] == ("f1:1", "AMENDED_RESTATEMENT", False)
    assert got["f2:2"] == (None, "UNKNOWN", True)  # two rows could be meant
    assert got["f4:1"] == (None, "UNKNOWN", True)  # nothing before it
    assert got["f3:1"] == (None, "AMENDED_ADDITION", False) and got["f1:1"] == (None, "ORIGINAL", False)


def test_a_filing_replaces_all_before_it(spark):
    rows, _ = observed(spark, FILINGS, [("f1", "1", "k1", "1"), ("f1", "2", "k2", "1"), ("f2", "1", "k1", "2"), ("f3", "1", "k1", "3"), ("f4", "1", "k1", "4"), ("f5", "1", "k1", "5")])
    assert {r.record for r in holdings.active(rows).filter("superseded").collect()} == {"f1:1", "f1:2"}
    got = sorted((r.accession, r.prior, r.prior_filings, r.replaced_rows, r.state) for r in holdings.lineages(rows).collect())
    assert got == [("f2", "f1", 1, 2, "PRIOR_RETAINED_FILING_SUPERSEDED"), ("f4", None, 0, 0, "NO_PRIOR_TARGET_ROWS_RETAINED")]
    assert holdings.active(rows.limit(0)).count() == holdings.lineages(rows.limit(0)).count() == 0
