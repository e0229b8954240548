from __future__ import annotations

import hashlib
import itertools
import random
import time

import pytest

from freshhaul.llm.conversation_repair import NEXT, RENEW, cheapest, repair_edits, repaired_turns, summaries
from freshhaul.llm.queries import op11_conversation_repair

LETTERS = {0: "s", 1: "u", 2: "a", 3: "x"}


def plain(codes: bytes) -> tuple[int, str]:
    """All edits with up to two inserts at one place, by exhaustive recursion."""
    found = []

    def go(i, state, cost, audit, inserts):
        if i == len(codes) and state in (0, 3):
            found.append((cost, audit))
        if inserts < 2:
            go(i, RENEW[state], cost + 3, audit + "I", inserts + 1)
        if i == len(codes):
            return
        fault, initial = divmod(codes[i], 4)
        go(i + 1, state, cost + 4, audit + "D", 0)
        if fault != 1:
            more = 3 * (fault == 2)
            go(i + 1, RENEW[state], cost + 3 + more, audit + "R", 0)
            if NEXT[state][initial] >= 0:
                go(i + 1, NEXT[state][initial], cost + more, audit + "K", 0)

    go(0, 0, 0, "", 0)
    return min(found)


def test_search_is_exhaustive_search():
    for n in range(3):
        for codes in itertools.product(range(12), repeat=n):
            assert cheapest(bytes(codes)) == plain(bytes(codes)), codes
    rng = random.Random(3)
    for _ in range(250):
        codes = bytes(rng.choices([0, 1, 1, 1, 2, 2, 3, 5, 9, 10], k=rng.randrange(3, 6)))
        assert cheapest(codes) == plain(codes), codes


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_compose(block):
    rng = random.Random(block)
    for _ in range(200):
        codes = bytes(rng.choices([0, 1, 1, 2, 2, 3, 5, 9, 10], k=rng.randrange(2, 15)))
        assert cheapest(codes, block) == cheapest(codes, 64), codes


def test_long_conversations_take_proportional_time():
    rng = random.Random(1)
    codes = bytes(rng.choices([0, 1, 1, 2, 2, 3, 5, 9, 10], k=3_000))
    start = time.perf_counter()
    cost, audit = cheapest(codes)
    assert time.perf_counter() - start < 20
    assert len(audit) >= len(codes) and cost > 0
    assert cheapest(bytes([1] * 5000))[0] == 7500  # every other one of 5,000 users


def by_hand(rows: list[tuple]) -> dict:
    """Summaries and repaired turns of small conversations."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            [(t is not None, t or 0, " " if r is None else r, " " if x is None else x)
             for c, t, r, x in rows if c == conv]
        )
        codes, seen, faults, last = bytearray(), set(), [0, 0, 0, 0], None
        for _, _, role, text in turns:
            bare = text.strip(" \t\n\x0b\x0c\r")
            initial = "sua".find(role[0]) if role and role[0] in "sua" else 3
            if not bare:
                faults[0], fault = faults[0] + 1, 1
            elif (role, text) in seen:
                faults[1], fault = faults[1] + 1, 1
            elif bare[-1] not in ".!?":
                faults[2], fault = faults[2] + 1, 2
            else:
                fault = 0
            seen.add((role, text))
            if last is not None and last + LETTERS[initial] not in ("su", "ua", "au"):
                faults[3] += 1
            last = LETTERS[initial]
            codes.append(fault * 4 + initial)
        numbers = [t for has, t, _, _ in turns if has]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = cheapest(bytes(codes))
        repaired, rest, state = [], iter(turns), 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(rest)[2:]
            if letter == "D":
                continue
            if letter == "K":
                state = NEXT[state]["sua".find(role[0])]
            else:
                state = RENEW[state]
                role = {2: "user", 3: "assistant"}[state]
            repaired.append((role, text))
        out[conv] = (len(turns), gaps, *faults, cost, audit), repaired
    return out


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
    (2, None, None, None), (2, 5, "user", "a "), (2, 5, "user", "a "), (2, 9, "", "b?"),
    (3, 1, "system", "s."), (3, 2, "system", "s."), (3, 2, "tool", "t!"), (3, 9, "assistant", "x. \n"),
    (None, 1, "user", "who."), (None, None, "user", "who."),
    (4, 1, "user", "word " * 60_000 + "."), (4, 2, "assistant", None),
    (5, None, "a", ""), (5, None, "a", " \t"),
]


@pytest.fixture
def talk(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
        return frame.selectExpr("*", *[f"'x' AS {c}" for c in ("copy", "seq", "edit", "fault", "texts")])

    return make


def found(edits) -> dict:
    out = {r[0]: (tuple(r)[1:], []) for r in summaries(edits).collect()}
    for r in sorted(repaired_turns(edits).collect(), key=lambda r: r.seq):
        out[r.conv_id][1].append((r.role, r.text))
    return out


def test_odd_rows(talk):
    assert found(repair_edits(talk(ODD))) == by_hand(ODD)
    assert repair_edits(talk(ODD).filter("false")).count() == 0


def test_random_conversations(talk):
    rng = random.Random(9)
    texts = ["One.", "Two", "Three!", " ", "", None, "Four?"]
    rows = [
        (rng.randrange(12), rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "tool"]), rng.choice(texts))
        for _ in range(120)
    ]
    rows += [(99, k, "user" if k % 3 else "assistant", f"t{k % 150}.") for k in range(400)]
    assert found(repair_edits(talk(rows))) == by_hand(rows)


def test_query_returns_every_conversation(spark, sf_dir):
    import zlib

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        x = {1: "", 2: x.translate(str.maketrans("", "", ".!?"))}.get(kind, x)
        hurt += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    want = by_hand(hurt)
    got = {r.conv_id: r for r in op11_conversation_repair(spark, sf_dir).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        faults, turns = want.get(conv, ((0, 0, 0, 0, 0, 0, 0, ""), []))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        assert tuple(row)[1:] == (*faults[1:], digest)
