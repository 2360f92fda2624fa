"""The pipeline's stages against their operators by brute force, and what the entry registers."""

import __spark_entry__ as entry
import corpus_pipeline
from corpusmill.llm import bpe, decontaminate, pii, quality, simhash
from tests.llm.edges import EDGE_TEXTS, docs

SF = "/root/testdata/sf0.001"


def test_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names >= {f"op{k}" for k in range(1, 11)} and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    columns = before.columns
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    scores = {r.doc_id: r.predicted for r in quality.report(before, labels).collect()}
    after = corpus_pipeline.quality_classifier(spark, before, SF)
    assert after.columns == columns and {r.doc_id for r in after.collect()} == {i for i, p in scores.items() if p}
    first = corpus_pipeline.simhash_near_dedup(spark, after, SF)
    component = {r.doc_id: r.component_id for r in simhash.report(after).collect()}
    assert first.columns == columns and sorted(r.doc_id for r in first.collect()) == sorted(set(component.values()))
    clean = corpus_pipeline.benchmark_decontamination(spark, first, SF)
    bad = {r.doc_id for r in decontaminate.report(first, bench).collect() if r.contaminated}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in first.collect()} - bad
    masked = corpus_pipeline.personal_data(spark, clean, SF)
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in masked.collect():
        spans = pii.base_spans(texts[r.doc_id])
        assert (r.text == texts[r.doc_id]) or spans and r.n_chars == len(r.text)
        assert all(texts[r.doc_id][a:b] not in r.text or b - a < 6 for a, _, b in spans)
    last = corpus_pipeline.bpe_encoding(spark, masked, SF).collect()
    assert sorted(map(tuple, last)) == sorted(map(tuple, bpe.report(masked).collect()))


def test_stages_on_edges(spark):
    for texts in (EDGE_TEXTS, []):
        d = docs(spark, texts)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, SF)
            out.collect()
