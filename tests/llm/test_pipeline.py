from __future__ import annotations

import corpus_pipeline
from freshhaul.llm.common import settle, table
from freshhaul.llm.queries import ORACLES, QUERIES


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = settle(stage(spark, docs, sf_dir), f"test-{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name in ("quality_classifier", "exact_dedup", "ngram_join"):
            kept = [r.doc_id for r in docs.collect()]
            assert len(kept) == len(set(kept)) and 0 < len(kept) <= before.count()
            assert all(texts[r.doc_id] == r.text for r in docs.collect())
    assert docs.filter("NOT round_trip").isEmpty() and docs.count() > 0


def test_no_documents(spark, tmp_path, odd):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd.select("doc_id", "text", "lang", "source", "n_chars").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
