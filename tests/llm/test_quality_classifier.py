from __future__ import annotations

import numpy as np

from freshhaul.llm import quality_classifier as q


def test_features_of_a_batch_are_those_of_each_text():
    texts = ["", "a", "the the cat", "  x\ty ", "🙂🙂 naïve", "word " * 50]
    buckets, owner = q.features(texts)
    for i, text in enumerate(texts):
        assert sorted(buckets[owner == i]) == sorted(q.features([text])[0]), text


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    table = rng.normal(0, 1, q.BUCKETS).astype(np.float32)
    texts = ["", "good words here", "bad bad bad " * 2000, "a", "x" * 400_000, "end"]
    together = q.score_texts(texts, table, 0.25)
    alone = [q.score_texts([t], table, 0.25)[0] for t in texts]
    assert np.allclose(together, alone)
    assert np.isclose(together[0], 1 / (1 + np.exp(-0.25)))


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = q.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 5
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)


def test_odd_rows_and_labels(odd, nothing, spark):
    labels = spark.createDataFrame(
        [(4, 1), (4, 1), (6, 0), (8, 0), (8, 1), (None, 1), (99, 0), (3, None)], "doc_id long, quality int"
    )
    assert {(r.doc_id, r.label) for r in q.known_labels(labels, "quality").collect()} == {
        (4, 1), (6, 0), (99, 0)
    }
    rows = q.quality_scores(odd, labels).collect()
    assert len(rows) == 10 and all(0 < r.score < 1 for r in rows)
    assert {r.predicted for r in rows if r.score < 0.3} <= {0}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert q.quality_scores(nothing, labels).count() == 0
    none = labels.filter("false")
    assert {r.score for r in q.quality_scores(odd, none).collect()} == {0.5}
    kept = q.good_documents(odd, none)
    assert kept.columns == odd.columns and kept.count() == 10
