from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from freshhaul.llm.mixing import apportion, mix, mixed, targets


def seats_by_hand(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 50])
def test_apportionment_is_sainte_lague(spark, seats):
    elections = {1: [53.0, 24.0, 23.0], 2: [1.0], 3: [5.0, 5.0, 5.0, 0.0], 4: [1e6, 1.0, 1.0, 1.0]}
    rows = [(e, i, v, seats) for e, votes in elections.items() for i, v in enumerate(votes)]
    frame = spark.createDataFrame(rows, "e int, i int, votes double, seats bigint")
    got = defaultdict(dict)
    for r in apportion(frame, "votes", "seats", ["e"], "i").collect():
        got[r.e][r.i] = r.quota
    for e, votes in elections.items():
        assert [got[e][i] for i in range(len(votes))] == seats_by_hand(votes, seats)


def test_excess_is_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 1)], "source string, size bigint")
    got = {r.source: r.target for r in targets(sizes).collect()}
    # Weights 5, 2, 1, 5: a and null stop at 3 times their size, the rest goes 2 : 1.
    assert got["a"] == 30 and got[None] == 3
    assert got["b"] == pytest.approx(1978 * 2 / 3) and got["c"] == pytest.approx(1978 / 3)


def test_words_taken_meet_the_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mix(docs, shard_words=2_000).collect()
    by = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by[r.target, r.source_size] += r.taken
    n_shards = {k: k[1] / 2_000 + 1 for k in by}
    for (target, size), taken in by.items():
        assert abs(target - taken) <= 16 * (n_shards[target, size] + 1)
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs, shard_words=2_000).collect()))


def test_the_mix_holds_the_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixed(docs)
    assert out.columns == docs.columns
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    got = {r[0]: r[1] for r in out.groupBy("doc_id").agg(F.sum(words)).collect()}
    assert got == {r.doc_id: r.taken for r in mix(docs).collect() if r.taken}


def test_odd_rows(odd, nothing):
    rows = mix(odd).collect()
    assert len(rows) == 10
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(r.taken == 0 for r in rows if not r.size)
    assert mixed(odd).columns == odd.columns
    assert mix(nothing).count() == 0 and mixed(nothing).count() == 0
    wordless = odd.filter("doc_id < 4")
    assert {(r.target, r.taken) for r in mix(wordless).collect()} == {(0.0, 0)}
