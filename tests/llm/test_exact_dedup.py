from __future__ import annotations

import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from freshhaul.llm.exact_dedup import CuckooIndex, exact_groups, groups, digests, withdraw, without_copies


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=300))
def test_index_is_a_dictionary(steps):
    index, plain = CuckooIndex(buckets=2, moves=4), {}
    for add, n in steps:
        digest = f"{n * 0x9E3779B97F4A7C15 % 2**64:016x}{n:048x}"
        if add:
            index.put(digest, (n,))
            plain[digest] = (n,)
        else:
            assert index.delete(digest) == (plain.pop(digest, None) is not None)
        assert index.get(digest) == plain.get(digest)
    assert dict(index.items()) == plain and index.size == len(plain)


def test_fingerprints_that_agree_are_verified():
    index = CuckooIndex()
    a, b = "ab12" + "0" * 60, "ab12" + "0" * 59 + "1"
    index.put(a, (1,))
    assert index.get(b) is None
    index.put(b, (2,))
    assert (index.get(a), index.get(b)) == ((1,), (2,))


def test_odd_rows(odd):
    rows = exact_groups(odd).collect()
    assert len(rows) == 10
    by_keep = Counter(r.keep_id for r in rows)
    # Empty texts: the longest original wins; of rows 5 exactly one stays.
    assert by_keep == {3: 3, 4: 2, 5: 2, 7: 2, 8: 1}
    assert sorted(r.doc_id for r in rows if r.kept) == [3, 4, 5, 7, 8]
    assert all(r.group_size == by_keep[r.keep_id] for r in rows)


def test_kept_documents(odd, nothing):
    kept = without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8]
    assert without_copies(nothing).count() == 0
    assert exact_groups(nothing).count() == 0


def test_flushing_changes_nothing(frame):
    rng = random.Random(5)
    docs = frame([(i, f"t{rng.randrange(30)}") for i in range(400)])
    hashed = digests(docs)
    plain = {(r.digest, r.copies, r.doc_id) for r in groups(hashed).collect()}
    assert plain == {(r.digest, r.copies, r.doc_id) for r in groups(hashed, flush=3).collect()}


def test_withdrawn_copies_leave_the_index(frame, spark):
    index = groups(digests(frame([(1, "a"), (2, "a"), (3, "b")])))
    found = {r.doc_id: r.digest for r in index.collect()}
    removed = spark.createDataFrame(
        [(found[1],), (found[3],), ("f" * 64,)], "digest string"
    )
    assert [(r.digest, r.copies) for r in withdraw(index, removed).collect()] == [(found[1], 1)]
