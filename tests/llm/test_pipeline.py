"""The pipeline's stages, each held against a plain version on its own input."""

from __future__ import annotations

from collections import defaultdict

import brute
import cases

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        seen[name] = (before, after)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    before, after = seen["quality_classifier"]
    good = [i for i in before if quality.get(i) == 1]
    assert sum(i in after for i in good) >= 0.97 * len(good)
    before, after = seen["near_dedup"]
    want = brute.components(list(before.items()), 5, 80)
    assert set(after) == {i for i in before if want[i] == i}
    before, after = seen["decontamination"]
    assert set(after) == {i for i in before if not brute.decontaminate(before[i], items)["n_hit"]}
    before, after = seen["secret_scan"]
    assert set(after) == set(before)
    for i, text in before.items():
        assert all(text[s:e] not in after[i] for s, _, _, e in brute.secrets(text))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(after)
    bins = defaultdict(int)
    for r in rows:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 2048 and len(bins) == -(-sum(bins.values()) // 2048)


def test_awkward_tables(spark, tmp_path):
    """Null, empty, very long and repeated texts, and no rows at all, through all stages."""
    for name, rows in (("odd", cases.TEXTS), ("none", [])):
        where = str(tmp_path / name)
        cases.docs(spark, rows).write.parquet(f"{where}/documents.parquet")
        cases.labels(spark, [(5, 1, 0), (None, 1, 0)] if rows else []).write.parquet(f"{where}/labels.parquet")
        cases.benchmark(spark, [(1, "nothing of this kind")]).write.parquet(f"{where}/benchmark.parquet")
        docs = spark.read.parquet(f"{where}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, where)
            assert docs.columns == cases.docs(spark).columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, where).collect()
        assert {r.doc_id for r in out} == {r.doc_id for r in docs.collect()}
        assert bool(out) == bool(rows)
