from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshhaul.llm.substring_dedup import PIECE, parts, without_repeats
from freshhaul.llm.suffix_array import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(0, 255), max_size=40)))
def test_suffix_array(symbols):
    expected = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert suffix_array(np.array(symbols, np.int64)).tolist() == expected


def by_hand(rows, length):
    strings = Counter(raw[i : i + length] for raw in rows for i in range(len(raw) - length + 1))
    out = []
    for raw in rows:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if strings[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = []
        for i, g in enumerate(gone):
            if g and i and gone[i - 1]:
                spans[-1][1] = i + 1
            elif g:
                spans.append([i, i + 1])
        out.append((len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (45, 80, 200, 600)]
    rows = [text(rng.randrange(200)) + rng.choice(shared) + text(rng.randrange(90)) for _ in range(60)]
    rows += [shared[2], shared[2], shared[3][100:400], "x" * 300, "ab" * 100, "", "short", text(1500)]
    for _ in range(20):  # near copies
        i = rng.randrange(600)
        rows.append(shared[3][:i] + "!" + shared[3][i + 1 :])
    return rows


@pytest.mark.parametrize("options", [{}, {"block": 1000}, {"block": 100}, {"gram": 40}, {"gram": 5}])
def test_against_all_strings(frame, options):
    rows = corpus(8)
    got = without_repeats(frame(list(enumerate(rows))), 40, **{"gram": 16} | options).collect()
    expected = by_hand([r.encode() for r in rows], 40)
    for r in got:
        assert (r.n_bytes, [list(s) for s in r.spans], bytes(r.kept)) == expected[r.doc_id]
    assert len(got) == len(rows)


def test_parts_share_no_string():
    length = 50
    for sizes in ([3 * PIECE + 7], [0, 10, length, PIECE, PIECE + length], [length - 1] * 5):
        starts = Counter((i, s) for p in parts(sizes, length) for i, a, b in p for s in (a, b - length))
        assert all(a <= b for p in parts(sizes, length) for _, a, b in p)
        whole = sum(max(0, b - a - length + 1) for p in parts(sizes, length) for _, a, b in p)
        assert whole == sum(max(0, n - length + 1) for n in sizes) and starts


def test_odd_rows(odd, nothing):
    rows = without_repeats(odd).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == by[2].n_bytes == 0 and bytes(by[1].kept) == b""
    # The two long texts differ in a trailing space: all but that goes.
    assert bytes(by[6].kept) == b"" and bytes(by[7].kept) == b" "
    assert without_repeats(nothing).count() == 0
