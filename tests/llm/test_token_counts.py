from __future__ import annotations

import random

import public_tokenizers as tokenizers
import pytest

from freshhaul.llm import token_counts as tc

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("width", [1, 7, tc.BIN])
def test_every_limit(spark, width):
    rng = random.Random(3)
    lengths = [0, 0, 5] + [rng.randrange(60) for _ in range(300)]
    frame = spark.createDataFrame([(x,) for x in lengths], "n_tokens bigint")
    sums = tc.suffix_sums(tc.length_histogram(frame), width)
    for r in tc.context_limits(sums).collect():
        limit = r.context_limit
        assert r.n_docs == lengths.count(limit)
        assert r.docs_from == sum(x >= limit for x in lengths)
        assert r.tokens_from == sum(x for x in lengths if x >= limit)
        assert r.whole_docs == sum(x <= limit for x in lengths)
        assert r.kept_tokens == sum(min(x, limit) for x in lengths)
        assert r.cut_tokens == sum(lengths) - r.kept_tokens
        assert r.quantile == pytest.approx(r.whole_docs / len(lengths))
    got = {r.context_limit: r.kept_tokens for r in tc.truncated_totals(sums, [0, 3, 17, 1000]).collect()}
    assert got == {k: sum(min(x, k) for x in lengths) for k in (0, 3, 17, 1000)}
    ordered = sorted(lengths)
    for r in tc.quantiles(sums, [0.0, 0.1, 0.5, 1.0]).collect():
        rank = max(1, -(-round(r.share * 1e6) * len(ordered) // 10**6))
        assert r.n_tokens == ordered[rank - 1]


def test_odd_rows(odd, nothing):
    rows = tc.token_counts(odd, PATH, tokenizers.PATTERN).collect()
    assert sum(r.n_docs for r in rows) == 10
    assert min(r.context_limit for r in rows) == 0
    assert tc.token_counts(nothing, PATH, tokenizers.PATTERN).count() == 0
