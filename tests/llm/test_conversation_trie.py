from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from freshhaul.llm import conversation_trie
from freshhaul.llm.common import settle
from freshhaul.llm.conversation_trie import contracted, ends_digests, prefix_trie, turn_rows
from freshhaul.llm.queries import rebuilt


def conversations(rows: list[tuple]) -> dict[int, list[tuple]]:
    out: dict[int, list[tuple]] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in out.items()}


def shared(convs: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def words(text: str) -> int:
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def plain(convs: dict[int, list[tuple]]) -> set[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, of in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = lambda n: [x for x in members if len(x) == len(n) + 1 and x[:-1] == n]
        ids = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(node))))
        out.add(
            (
                min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(kids(node)),
                sum(not kids(x) for x in below),
                sum((len(members[x]) - 1) * words(x[-1][1]) for x in below if x),
                hashlib.sha256(ids.encode()).hexdigest(),
            )
        )
    return out


def tried(frame, share) -> set[tuple]:
    turns = settle(turn_rows(frame), "turns")
    parts = rebuilt(turns) if share else (turns, turns.select("conv_id").distinct())
    trie, ends = prefix_trie(*parts)
    none = hashlib.sha256(b"").hexdigest()
    rows = trie.join(ends_digests(ends), ["depth", "a", "b"], "left").fillna(none, ["ends_sha256"])
    out = [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in rows.collect()
    ]
    assert len(out) == len(set(out))
    return set(out)


@pytest.fixture
def talk(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
        return frame.selectExpr("*", *[f"'x' AS {c}" for c in ("place", "depth", "a", "b", "k", "part")])

    return make


ODD = [
    (0, 0, "user", "a b"), (0, 1, "assistant", None), (0, 2, "user", "c"),
    (1, None, None, None), (1, None, None, None), (1, 3, "user", "x " * 50_000),
    (2, 7, "user", "a b"), (5, 1, "user", "only"),
    (None, 1, "user", "lost"), (40, 2, "ab", "c"), (41, 2, "a", "bc"), (47, 1, "user", "z"),
]


def test_odd_rows(talk):
    convs = conversations(ODD)
    assert tried(talk(ODD), False) == plain(convs)
    assert tried(talk(ODD), True) == plain(shared(convs))
    assert tried(talk(ODD).filter("false"), True) == set()


def test_random_conversations(talk):
    rng = random.Random(8)
    rows = []
    for c in range(70):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, ["user", "assistant"][t % 2], f"w{rng.randrange(2)} y"))
    assert tried(talk(rows), True) == plain(shared(conversations(rows)))


def test_windows_restart(talk, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 3)
    rows = [(c, t * 2 if t else None, "user", f"m{t}") for c in (0, 1, 2) for t in range(11 - c)]
    rows += [(3, t, "user", f"m{t}") for t in (-7, -2, 0, 1, 5, 9, 10)]
    assert tried(talk(rows), False) == plain(conversations(rows))


def test_chain_takes_few_rounds(spark, monkeypatch):
    names = []

    def counted(df, name):
        names.append(name)
        return settle(df, name)

    monkeypatch.setattr(conversation_trie, "settle", counted)
    n = 400
    nodes = spark.range(n + 1).selectExpr(
        "7L AS conv_id", "id AS depth", "IF(id > 0, 7L, NULL) AS parent_conv_id", "IF(id > 0, id - 1, NULL) AS parent_depth",
        f"IF(id < {n}, 1L, 0L) AS n_children", f"IF(id = {n}, 1L, 0L) AS leaves", "id AS saved",
    )
    got = {r.depth: (r.leaves, r.saved) for r in contracted(nodes).collect()}
    assert got == {d: (1, sum(range(d, n + 1))) for d in range(n + 1)}
    assert names.count("trie-raked") < 40
