"""The pipeline's stages against brute force on the smallest tables."""

import re

import corpus_pipeline as pipeline
from textmill.llm import simhash
from textmill.sources.storage import cut_lineage

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    out = {}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = cut_lineage(stage(spark, docs, FOLDER))
        out[name] = (before, docs.collect())
    names = list(out)
    before, after = out[names[0]]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or "")}
    before, after = out[names[1]]
    lines = {r.doc_id: r.text.split("\n") for r in before}
    assert all(set(r.text.split("\n")) <= set(lines[r.doc_id]) and r.n_chars == len(r.text) for r in after)
    before, after = out[names[2]]
    prints = {r.doc_id: simhash.fingerprint_of(r.text.encode()) for r in before}
    kept = {r.doc_id for r in after}
    assert all(min(d for d in prints if (prints[d] ^ prints[k]).bit_count() <= 3) == k for k in kept)
    assert all(any((prints[d] ^ prints[k]).bit_count() <= 12 for k in kept) for d in prints)
    before, after = out[names[3]]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not any(i in r.text for i in items)}
    assert all(list(out[n][1][0].asDict()) == columns for n in names[:4])
    before, after = out[names[4]]
    size = {r.doc_id: len(r.text.split()) for r in before}
    assert all(0 < r.taken <= 2 * size[r.doc_id] for r in after)
    assert abs(sum(r.taken for r in after) - 1.5 * sum(size.values())) < 40


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(docs.collect()) == sorted(pipeline.run(spark, FOLDER).collect())
