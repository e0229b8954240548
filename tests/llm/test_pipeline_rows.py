"""Each stage and the whole pipeline against plain Python, and the mix against its SQL."""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_ngram_join import brute

from freshhaul.llm.common import settle, table
from freshhaul.llm.ngram_join import Rule
from freshhaul.llm.quality_classifier import quality_scores
from freshhaul.llm.sql import MIX

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows after each stage, by name."""
    docs, out = table(spark, sf_dir, "documents"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs.collect()
    return out


@pytest.fixture(scope="module")
def plain(spark, sf_dir):
    """Texts by id after each of the filters, and the words that the mix takes of each."""
    docs = table(spark, sf_dir, "documents")
    scored = quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "text", "score").collect()
    good = {r.doc_id: r.text or "" for r in scored if r.score >= 0.3}
    equal = defaultdict(list)
    for doc, text in good.items():
        equal["".join(re.findall(WORD, text))].append((-len(text), doc))
    single = {doc: good[doc] for _, doc in map(min, equal.values())}
    linked = brute(list(single.items()), Rule(words=5, percent=80))
    apart = {doc: single[doc] for doc, _, component in linked if doc == component}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM '" + f"{sf_dir}/documents.parquet" + "'")
    con.execute("CREATE TABLE kept (doc_id BIGINT)")
    con.executemany("INSERT INTO kept VALUES (?)", [(d,) for d in apart])
    con.execute("DELETE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM kept)")
    rows = con.execute(f"SELECT doc_id, taken FROM ({MIX})").fetchall()
    return {
        "quality_classifier": good, "exact_dedup": single, "ngram_join": apart,
        "taken": {doc: n for doc, n in rows if n},
    }


@pytest.fixture(scope="module")
def known():
    with open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("name", ["quality_classifier", "exact_dedup", "ngram_join"])
def test_kept_documents(stages, plain, name):
    assert sorted(r.doc_id for r in stages[name]) == sorted(plain[name])
    assert 0 < len(plain["ngram_join"]) < len(plain["exact_dedup"]) < len(plain["quality_classifier"])


def is_mix(rows, plain):
    """``rows`` (doc_id, text) hold the words taken of each document, in whole runs of them."""
    taken = Counter()
    for doc, text in rows:
        source = plain["ngram_join"][doc]
        words = re.findall(WORD, text)
        assert words and (text == source or f" {' '.join(words)} " in f" {' '.join(re.findall(WORD, source))} ")
        taken[doc] += len(words)
    assert taken == plain["taken"]


def test_words_taken(stages, plain):
    is_mix([(r.doc_id, r.text) for r in stages["mix_sources"]], plain)


def test_ids(stages, known):
    want = Counter((r.doc_id, tuple(known.encode_ordinary(r.text))) for r in stages["mix_sources"])
    rows = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in stages["byte_bpe"]]
    assert Counter(rows) == want
    assert all(r.n_tokens == len(ids) for r, (_, ids) in zip(stages["byte_bpe"], rows, strict=True))


def test_rows_of_run(spark, sf_dir, plain, stages, known):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    texts = [(r.doc_id, known.decode(np.frombuffer(r.ids, "<u4").tolist())) for r in rows]
    is_mix(texts, plain)
    assert all(
        known.encode_ordinary(text) == np.frombuffer(r.ids, "<u4").tolist()
        for r, (_, text) in zip(rows, texts, strict=True)
    )
    assert Counter(texts) == Counter((r.doc_id, r.text) for r in stages["mix_sources"])
