"""The pipeline against a plain version of its stages."""

import math
import re

import brute
import corpus_pipeline
from conftest import SF_DIR

from stockloom.llm import components, langid, simhash


def plain(docs, items):
    roots = brute.simhash_components({d.doc_id: d.text for d in docs})
    left = [d for d in docs if roots[d.doc_id] == d.doc_id]
    bare = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    left = [d for d in left if not any(bare(b.text) in bare(d.text) for b in items)]
    rows = []
    for doc_id, size, *_, taken, _, _ in brute.mix([(d.doc_id, d.source, len(d.text.split())) for d in left]):
        times = taken // size + (2 * (taken % size) >= size) if size else 0
        rows += [(doc_id, brute.jump(doc_id, corpus_pipeline.SHARDS))] * times
    return sorted(rows)


def test_run_equals_plain_version(spark, documents):
    docs = documents.collect()
    model = langid.train(documents)
    names = [langid.score(d.text, model["langs"], model["matrix"], model["prior"]) for d in docs]
    kept = [d for d, (name, score) in zip(docs, names) if name != "und" and score >= langid.REJECT]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == [*documents.columns, "shard"]
    assert sorted((r.doc_id, r.shard) for r in got.select("doc_id", "shard").collect()) == plain(kept, items)
    texts = {d.doc_id: d.text for d in docs}
    assert all(texts[r.doc_id] == r.text for r in got.select("doc_id", "text").collect())
    assert math.isclose(sum(len(r.text.split()) for r in got.collect()), sum(len(d.text.split()) for d in kept), rel_tol=0.2)


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for name, function in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            got = function(spark, docs, SF_DIR)
            assert got.columns[: len(docs.columns)] == docs.columns or name == "shards"
            n = got.count()
            assert n == 0 if docs is no_docs else n > 0


def test_near_copies_broadcast_no_exploded_table(spark, documents, monkeypatch):
    made, stage = {}, simhash.stage
    for module in (simhash, components):
        monkeypatch.setattr(module, "stage", lambda df, label: made.setdefault(label, df) and stage(df, label))
    corpus_pipeline.near_copies(spark, documents, SF_DIR)
    for label in ("simhash-buckets", "simhash-links"):
        plan = made[label]._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
