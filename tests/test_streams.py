"""Streams: arrivals with duplicates as errors, commits that survive failures, restatement by period, event rules."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import changes
from ledgerline.streaming import arrivals, commits, incremental, restating

ROWS = "id string, seq long, said string"


def _drop(spark, folder, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def _arrived(spark, folder):
    stream = incremental.events(spark, f"{folder}/in", spark.createDataFrame([], ROWS).schema)
    schema = arrivals.evaluate(stream, "id", ["seq"], str(folder))
    rows, errors = arrivals.outcomes(spark, str(folder), schema)
    return {tuple(r)[:3] for r in rows.collect()}, sorted((tuple(r)[:3] for r in errors.collect()), key=str), errors


def test_duplicates_are_errors_across_restarts(spark, tmp_path):
    _drop(spark, tmp_path, [("a", 2, "second"), ("a", 1, "first"), ("b", 3, "b"), (None, 4, "none")])
    rows, errors, _ = _arrived(spark, tmp_path)
    assert rows == {("a", 1, "first"), ("b", 3, "b"), (None, 4, "none")} and errors == [("a", 2, "second")]
    # the stream starts anew from its checkpoint and still knows its ids
    _drop(spark, tmp_path, [("a", 0, "late, though earlier by number"), ("c", 9, "c"), (None, 5, "again"), ("b", 10, "b2"), ("b", 11, "b3")])
    rows, errors, table = _arrived(spark, tmp_path)
    assert rows == {("a", 1, "first"), ("b", 3, "b"), (None, 4, "none"), ("c", 9, "c")}
    assert errors == sorted([("a", 2, "second"), ("a", 0, "late, though earlier by number"), (None, 5, "again"), ("b", 10, "b2"), ("b", 11, "b3")], key=str)
    assert {r.error for r in table.collect()} == {"duplicate id"}
    # nothing new: nothing changes
    assert _arrived(spark, tmp_path)[:2] == (rows, errors)


def test_many_arrivals_of_one_id(spark, tmp_path):
    _drop(spark, tmp_path, [("hot", (7 * k) % 30_011, "x") for k in range(30_011)])
    rows, errors, _ = _arrived(spark, tmp_path)
    assert rows == {("hot", 0, "x")} and len(errors) == 30_010


def test_arrivals_of_one_batch_in_native_steps(spark, tmp_path):
    """No row goes through Python, whatever the number of ids; nulls in the order come last."""
    _drop(spark, tmp_path, [("a", None, "x"), ("a", 2, "y"), ("b", None, "z"), (None, 2, "n2"), (None, 1, "n1")])
    stream = incremental.events(spark, f"{tmp_path}/in", spark.createDataFrame([], ROWS).schema)
    plans = []

    def look(batch, number):
        found = arrivals.judged(batch, ["seq"])
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        commits.exactly_once(f"{tmp_path}/out", "outcome")(found, number)

    incremental.run_available(arrivals.with_new_keys(stream, "id"), f"{tmp_path}/state", look)
    assert len(plans) == 1 and "Python" not in plans[0] and "Pandas" not in plans[0]
    rows, errors, _ = _arrived(spark, tmp_path)
    assert rows == {("a", 2, "y"), ("b", None, "z"), (None, 1, "n1")} and errors == [("a", None, "x"), (None, 2, "n2")]


def test_failed_batch_is_neither_lost_nor_doubled(spark, tmp_path):
    folder = str(tmp_path)
    _drop(spark, folder, [("a", 1, "x"), ("b", 2, "y")])
    stream = lambda: incremental.events(spark, f"{folder}/in", spark.createDataFrame([], ROWS).schema)
    sink = commits.exactly_once(f"{folder}/out")
    state = {"fail": True}

    def breaks(batch, number):
        if state["fail"]:
            batch.limit(1).write.parquet(f"{folder}/out/batch={number}")  # files without a commit
            raise RuntimeError("lost")
        sink(batch, number)

    read = lambda: sorted(r.id for r in commits.committed(spark, f"{folder}/out", stream().schema).collect())
    with pytest.raises(Exception, match="lost"):
        incremental.run_available(stream(), f"{folder}/state", breaks)
    assert read() == []
    state["fail"] = False
    incremental.run_available(stream(), f"{folder}/state", breaks)
    assert read() == ["a", "b"]
    sink(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ROWS), 0)  # the same batch once more
    assert read() == ["a", "b"]
    _drop(spark, folder, [("c", 3, "z")])
    incremental.run_available(stream(), f"{folder}/state", breaks)
    assert read() == ["a", "b", "c"]


HISTORY = "period string, key string, version long, value long"


def _batches():
    first = [(f"2024-0{m}", k, 1, 10 * m) for m in range(1, 6) for k in "ab"]
    second = [("2024-02", "a", 2, 99), ("2024-02", "c", 1, 5), ("2024-04", "b", 0, -1)]
    third = [("2024-02", "a", 2, 99), ("2024-06", "a", 1, 60)]
    return [first, second, third]


def test_restatement_touches_only_its_periods(spark, tmp_path):
    folder = str(tmp_path)
    sink = restating.restate_into(folder, ["period", "key"], "period", ["version"])
    schema = spark.createDataFrame([], HISTORY).schema
    batches = [spark.createDataFrame(b, HISTORY) for b in _batches()]
    sink(batches[0], 0)
    before = {r.period: r.file for r in restating.restated(spark, folder, schema).select("period", F.input_file_name().alias("file")).collect()}
    sink(batches[1], 1)
    after = {r.period: r.file for r in restating.restated(spark, folder, schema).select("period", F.input_file_name().alias("file")).collect()}
    assert {p for p in before if before[p] != after[p]} == {"2024-02", "2024-04"}
    sink(batches[2], 2)
    sink(batches[2], 2)  # run twice
    now = {(r.period, r.key): r.value for r in restating.restated(spark, folder, schema).collect()}
    want = {}
    for p, k, v, x in sorted((r for b in _batches() for r in b), key=lambda r: r[2]):
        want[p, k] = x
    assert now == want and now["2024-02", "a"] == 99 and now["2024-04", "b"] == 40
    # the table as it was, until old files go
    assert {(r.period, r.key): r.value for r in restating.restated(spark, folder, schema, at=0).collect()}["2024-02", "a"] == 20
    assert restating.vacuum(spark, folder) > 0
    assert {(r.period, r.key): r.value for r in restating.restated(spark, folder, schema).collect()} == want


def test_restatement_after_a_failed_batch(spark, tmp_path):
    folder = str(tmp_path)
    sink = restating.restate_into(folder, ["period", "key"], "period", ["version"])
    batches = [spark.createDataFrame(b, HISTORY) for b in _batches()]
    sink(batches[0], 0)
    batches[1].limit(1).withColumn("_period", F.col("period")).write.partitionBy("_period").parquet(f"{folder}/batch=1")  # no commit
    assert restating.restated(spark, folder, batches[0].schema).count() == 10
    sink(batches[1], 1)
    assert restating.restated(spark, folder, batches[0].schema).count() == 11
    assert restating.restated(spark, f"{folder}/none", batches[0].schema).count() == 0
    sink(spark.createDataFrame([], HISTORY), 2)
    assert restating.restated(spark, folder, batches[0].schema).count() == 11


def test_versions_survive_a_gap(spark, tmp_path):
    path = f"{tmp_path}/t"
    sink = incremental.upsert_into(path, ["id"])
    sink(spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string"), 0)
    spark.createDataFrame([(9, "torn")], "id long, x string").write.parquet(f"{path}/v=1")  # a version without a commit
    sink(spark.createDataFrame([(2, "c")], "id long, x string"), 2)
    assert {tuple(r) for r in spark.read.parquet(f"{path}/v=2").collect()} == {(1, "a"), (2, "c")}


def _event(**more):
    base = {
        "change_event_id": "e1", "affected_entity_id": "x", "event_type": "MERGER", "status": "DISSOLVED", "certification_state": "PASS",
        "confidence": "0.9", "evidence": ["ENACTED_LAW_OR_CONSTITUTION"], "predecessors": ["a", "b"], "successors": ["c"],
        "instrument_date": "2024-01-01", "effective_date": "2024-02-01", "announcement_date": None, "implementation_date": None,
        "assets": [], "appropriations": [], "contracts": [], "personnel": [],
    }
    return base | more


SCHEMA = """change_event_id string, affected_entity_id string, event_type string, status string, certification_state string, confidence string,
evidence array<string>, predecessors array<string>, successors array<string>, instrument_date string, effective_date string, announcement_date string,
implementation_date string, assets array<string>, appropriations array<string>, contracts array<string>, personnel array<string>"""


def _evaluate(spark, *events):
    names = [f.split()[0] for f in SCHEMA.replace("\n", " ").split(", ")]
    return changes.evaluated(spark.createDataFrame([tuple(e[n] for n in names) for e in events], SCHEMA)).collect()


def test_event_meaning(spark):
    merger, renaming, contracts, pending = _evaluate(
        spark,
        _event(),
        _event(event_type="RENAMING", predecessors=[], successors=[], status="ACTIVE"),
        _event(event_type="TRANSFER_OF_CONTRACTS", predecessors=[], successors=[], evidence=["PROCUREMENT_OR_CONTRACT_TRANSFER_RECORD"], personnel=["p"]),
        _event(event_type="DISSOLUTION", evidence=["NEWS_REPORT"], predecessors=[], successors=[]),
    )
    assert (merger.severity, merger.binding, merger.timeline_state, merger.cardinality, merger.alert) == ("S4", True, "DISSOLVED", "N:1", True)
    assert len(merger.scopes) == 11 and merger.reasons == ["MAJOR_OR_STRUCTURAL_CHANGE", "MONEY_OR_CONTROL_EDGE_RECOMPUTE", "SUCCESSION_RECOMPUTE"]
    assert (renaming.severity, renaming.alert, renaming.scopes, renaming.reasons) == ("S0", False, changes.ALWAYS, [])
    assert contracts.binding and contracts.scopes == ["CONTRACT_GRAPH", "ENTITY_GRAPH", "HISTORICAL_CONTINUITY_GRAPH", "PERSONNEL_GRAPH", "VENDOR_GRAPH"]
    # a terminal state that nothing binds isn't believed
    assert (pending.binding, pending.timeline_state) == (False, "UNKNOWN")
    assert "SUCCESSION_CARDINALITY_UNRESOLVED" in pending.reasons and "NONBINDING_OR_NOT_YET_EFFECTIVE" in pending.reasons


@pytest.mark.parametrize(
    "more,said",
    [
        ({"affected_entity_id": " "}, "identity missing"),
        ({"event_type": "LUNCH"}, "unsupported event_type"),
        ({"status": None}, "unsupported status"),
        ({"certification_state": "?"}, "unsupported certification_state"),
        ({"confidence": "high"}, "confidence outside 0 to 1"),
        ({"confidence": "1.2"}, "confidence outside 0 to 1"),
        ({"predecessors": ["a", "a"]}, "entity named twice"),
        ({"successors": [" "]}, "empty entity id"),
        ({"effective_date": "tomorrow"}, "unreadable date"),
        ({"effective_date": "2023-12-31"}, "effective before instrument"),
        ({"announcement_date": "2024-03-01", "implementation_date": "2024-02-01"}, "implemented before announced"),
        ({"evidence": []}, "evidence missing or unknown"),
        ({"evidence": ["APPROPRIATIONS_ACT"]}, "succession without authority"),
        ({"evidence": ["LEGISLATIVE_PROPOSAL"], "predecessors": [], "successors": []}, "proposal can't bind"),
        ({"event_type": "RENAMING"}, "renaming isn't succession"),
    ],
)
def test_event_faults(spark, more, said):
    (r,) = _evaluate(spark, _event(**more))
    assert r.fault == said and r.severity is None and r.alert is None
