from __future__ import annotations

import random
import time
from collections import Counter

from freshhaul.llm.repetition import Limits, measures, repeats, repetition_rules


def by_hand(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    longest = 0
    for size in range(8, len(words)):
        if max(Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)).values()) < 2:
            break
        longest = size
    return len(covered), longest


def test_against_windows():
    rng = random.Random(1)
    for _ in range(150):
        texts = [
            [rng.choice("ab" if rng.random() < 0.5 else "abcd") for _ in range(rng.choice([0, 1, 5, 9, 20, 60]))]
            for _ in range(rng.randrange(1, 6))
        ]
        covered, longest = repeats(texts)
        assert list(zip(covered.tolist(), longest.tolist())) == [by_hand(t) for t in texts]


def test_counts(frame):
    text = "a #b\nc d\n\n \nc d\nc d \n|x|"
    row = measures(frame([(1, text)])).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == (9, 12, 3, 1)


def test_verdicts(frame):
    clean = " ".join(f"w{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = {
        1: clean,
        2: "too short",
        3: "again and " * 40,
        4: f"{passage} {clean[:300]} {passage}" + " ".join(f"z{i}" for i in range(200)),
        5: clean + " " + " ".join(f"w{i}" for i in range(12)),
    }
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition_rules(frame(list(rows.items()))).collect()}
    assert got[1] == (False, True) and got[5] == (False, True)
    assert got[2] == got[3] == (True, False)
    strict = repetition_rules(frame([(5, rows[5])]), Limits(covered=1)).first()
    assert (strict.base_failed, strict.kept) == (False, False)
    assert got[4] == (True, False) or got[4] == (False, False)


def test_odd_rows(odd, nothing):
    rows = repetition_rules(odd).collect()
    assert len(rows) == 10
    assert {(r.n_words, r.base_failed, r.kept) for r in rows if r.doc_id in (1, 2, 3)} == {(0, True, False)}
    assert all(r.kept for r in rows if r.doc_id in (6, 7))
    assert repetition_rules(nothing).count() == 0


def test_equal_words_take_proportional_time():
    start = time.perf_counter()
    covered, longest = repeats([["a"] * 40_000, ["b", "a"] * 10_000])
    assert time.perf_counter() - start < 5
    assert (covered.tolist(), longest.tolist()) == ([40_000, 20_000], [39_999, 19_998])
