"""Layers of a registry and rule sets from tables."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import registry


def _write(root, **files):
    for name, said in files.items():
        path = root / (name.replace("__", "/") + ".json")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(said))
    return str(root)


BASE = {"version": 3, "sources": [{"source_id": "a", "title": "A", "required": True, "outputs": ["x", "y"]}, {"source_id": "b", "title": "B", "required": False}]}


def test_overrides_win_field_by_field(spark, tmp_path):
    root = _write(tmp_path, base=BASE, extensions__one={"sources": [{"source_id": "c", "title": "C"}]}, overrides__x={"source_overrides": [{"source_id": "a", "title": "A2", "required": True, "note": "new"}]})
    entries = registry.read_layers(spark, root)
    assert registry.faults(entries).count() == 0
    table = registry.merged(entries)
    got = {(r.source_id, r.field): (r.value, r.layer) for r in table.collect()}
    assert got["a", "title"] == ("A2", "override") and got["a", "note"] == ("new", "override")
    assert json.loads(got["a", "outputs"][0]) == ["x", "y"] and got["a", "outputs"][1] == "base"
    assert got["b", "title"] == ("B", "base") and got["c", "title"] == ("C", "extension")
    assert {r.source_id: r.title for r in registry.wide(table, ["title", "note"]).collect()} == {"a": "A2", "b": "B", "c": "C"}
    with pytest.raises(ValueError, match="no source has titel"):
        registry.wide(table, ["title", "titel"])


@pytest.mark.parametrize(
    "files,said",
    [
        ({"overrides__x": {"source_overrides": [{"source_id": "zz", "title": "?"}]}}, "zz: override of an unknown source"),
        ({"overrides__x": {"source_overrides": [{"source_id": "b", "required": True}]}}, "b: override of a fixed field"),
        ({"overrides__x": {"source_overrides": [{"title": "?"}]}}, "source_id missing"),
        ({"overrides__x": {"source_overrides": [{"source_id": "b", "title": "1"}]}, "overrides__y": {"source_overrides": [{"source_id": "b", "note": "2"}]}}, "b: duplicate override"),
        ({"extensions__x": {"sources": [{"source_id": "a", "title": "again"}]}}, "a: duplicate source_id"),
    ],
)
def test_faults_raise(spark, tmp_path, files, said):
    entries = registry.read_layers(spark, _write(tmp_path, base=BASE, **files))
    with pytest.raises(ValueError, match=said):
        registry.merged(entries)
    got = {(r.source_id, r.field): r.value for r in registry.merged(entries, strict=False).collect()}
    assert got["a", "title"] == "A" and got["b", "required"] == "false" and ("zz", "title") not in got


def test_rules_from_a_table(spark):
    rows = [("roads", "bridge", 2), ("roads", "carretera", 1), ("power", "grid", 3), ("power", "grid", 4), ("power", "", 5), (None, "x", 6)]
    table = spark.createDataFrame(rows, "label string, word string, place int")
    rules = registry.rule_words(table)
    assert rules == {"roads": ("carretera", "bridge"), "power": ("grid",)}
    texts = spark.createDataFrame([(1, "The Bridge on the GRID"), (2, "a grid"), (3, "nothing"), (4, None)], "i int, t string")
    got = {r.i: (r.r.labels, r.r.route) for r in texts.select("i", registry.routed(F.col("t"), rules, ["roads"]).alias("r")).collect()}
    assert got == {1: (["power", "roads"], "canonical"), 2: (["power"], "derivative"), 3: ([], "review"), 4: ([], "review")}
    by = registry.labels_by_word(texts, "i", F.split(F.lower(F.coalesce("t", F.lit(""))), " "), table)
    assert {r.i: r.labels for r in by.collect()} == {1: ["power", "roads"], 2: ["power"]}
    with pytest.raises(ValueError, match="no rules for water"):
        registry.routed(F.col("t"), rules, ["water"])
    many = spark.range(registry.MOST_RULES + 1).selectExpr("'l' AS label", "string(id) AS word", "id AS place")
    with pytest.raises(ValueError, match="rules"):
        registry.rule_words(many)
