from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from freshhaul.llm.byte_bpe import Encoder, Ranks, corpora, encode_documents

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return Ranks(PATH, tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


PIECES = st.sampled_from("the is in ing th er e s t ation  \n 漢 🙂 é 12 '' \x85 <|endoftext|> aaa ß".split(" "))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.lists(PIECES, max_size=12).map("".join)), max_size=6))
def test_ids_are_those_of_the_library(ranks, known, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [ids(x) for x in Encoder(ranks, cache=20)(texts)]
    assert got == [known.encode_ordinary(t) for t in texts]


def test_long_words(ranks, known):
    for text in ("a" * 5_000, "ab" * 3_000, "x" * 3 + " y" * 2_000):
        assert ids(next(Encoder(ranks)([text]))) == known.encode_ordinary(text)


def test_corpora_are_consecutive():
    texts = ["a" * n for n in (0, 5, 3, 12, 1)]
    assert [t for part in corpora(texts, 8) for t in part] == texts


def test_documents(spark, sf_dir, known):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in encode_documents(docs, PATH, tokenizers.PATTERN).collect():
        assert ids(r.ids) == known.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode() and r.n_tokens == len(ids(r.ids))


def test_odd_rows(odd, nothing, known):
    rows = encode_documents(odd, PATH, tokenizers.PATTERN).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == 0 and bytes(by[1].decoded) == b""
    assert hashlib.sha256(bytes(by[8].decoded)).digest()
    assert encode_documents(nothing, PATH, tokenizers.PATTERN).count() == 0
