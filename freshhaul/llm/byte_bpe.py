"""Byte-level BPE encoding and decoding by replaying merges over a corpus.

The corpus is what a task has at hand: the distinct words (matches of the pattern) of about a
megabyte of text, each held once, and ``REPLAY`` bytes of them at a time. An index leads from each mergeable pair of tokens to
the positions where it stands. Pairs are merged in order of rank, a heap naming the lowest
that is present; a merge touches its two neighbours only, whose new pairs enter the index.
If one of them ranks lower than the pair being replayed, it goes first and the rest of the
positions wait, so every word sees its merges in exactly the order that it would alone.

Encoded words stay in a bounded cache for the next piece of the task.

Ids are binary: little-endian unsigned 32-bit integers, one after the other. Null texts
count as empty and give no ids. Special tokens do not exist: their strings are plain text.
Words of any length are replayed whole; a text is never cut. Repeated rows are encoded each.
Columns that a frame has besides the text neither matter nor clash. No rows in, no rows out.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.llm.common import text_of

#: Characters of text that are taken together; a longer text is taken by itself.
CORPUS = 1_000_000
#: Bytes of distinct words that are replayed together; a longer word is replayed by itself.
REPLAY = 250_000
#: Encoded words that a task keeps for its next texts.
CACHE = 400_000


class Ranks:
    """Tokens by id and every pair of tokens that merges, with the id it merges to."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = pattern
        self.tokens = [b""] * (max(ids.values()) + 1)
        for token, rank in ids.items():
            self.tokens[rank] = token
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.width = len(self.tokens)
        self.pairs: dict[int, int] = {}
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank


def encode_words(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """Packed ids of each word; no word is empty."""
    pairs, width = ranks.pairs, ranks.width
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    first = ranks.single[raw]
    after = np.arange(1, len(raw) + 1)
    after[ends - 1] = -1
    before = np.arange(-1, len(raw) - 1)
    before[0] = -1
    before[ends[:-1]] = -1

    # The index over the single bytes: positions by rank of the pair that starts there.
    at = np.flatnonzero(after >= 0)
    keys, where = np.unique(first[at] * width + first[at + 1], return_inverse=True)
    rank_of = np.array([pairs.get(k, -1) for k in keys.tolist()], np.int64)[where] if len(at) else at
    at, rank_of = at[rank_of >= 0], rank_of[rank_of >= 0]
    order = np.argsort(rank_of, kind="stable")
    at, rank_of = at[order], rank_of[order]
    cuts = np.flatnonzero(np.diff(rank_of)) + 1
    heads = rank_of[np.concatenate([[0], cuts])].tolist() if len(at) else []
    index = dict(zip(heads, map(np.ndarray.tolist, np.split(at, cuts)), strict=True)) if heads else {}

    present = np.full(len(raw), -1, np.int64)
    present[at] = rank_of
    symbol, right, left = (array("i", x.astype(np.int32).tobytes()) for x in (first, after, before))
    # Rank of the pair that starts at a position, -1 if it has none.
    pair = array("i", present.astype(np.int32).tobytes())
    look = pairs.get
    heap = list(index)
    heapify(heap)
    while heap:
        rank = heappop(heap)
        positions = index.pop(rank, None)
        if positions is None:
            continue
        positions.sort()
        start = rank * width
        lower = False
        for k, i in enumerate(positions):
            if pair[i] != rank:
                continue  # a neighbour was merged away meanwhile
            j = right[i]
            n = right[i] = right[j]
            symbol[i], symbol[j], pair[j] = rank, -1, -1
            p = left[i]
            if n < 0:
                pair[i] = -1
            else:
                left[n] = i
                new = pair[i] = look(start + symbol[n], -1)
                if new >= 0:
                    lower = new < rank
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        heappush(heap, new)
            if p >= 0:
                new = pair[p] = look(symbol[p] * width + rank, -1)
                if new >= 0:
                    lower = lower or new < rank
                    if new in index:
                        index[new].append(p)
                    else:
                        index[new] = [p]
                        heappush(heap, new)
            if lower:
                index[rank] = positions[k + 1 :] + index.get(rank, [])
                heappush(heap, rank)
                break

    final = np.array(symbol, np.int64)
    live = np.concatenate([[0], np.cumsum(final >= 0)])[np.concatenate([[0], ends])] * 4
    packed = final[final >= 0].astype("<u4").tobytes()
    bounds = live.tolist()
    return [packed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Encoder:
    def __init__(self, ranks: Ranks, cache: int = CACHE) -> None:
        self.ranks = ranks
        self.limit = cache
        self.words = regex.compile(ranks.pattern).findall
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text, the words of all texts replayed together."""
        split = [self.words(t) for t in texts]
        fresh = list(set().union(*split).difference(self.known))
        if len(self.known) + len(fresh) > self.limit:
            self.known = {}
            fresh = list(set().union(*split))
        if fresh:
            for part in corpora(fresh, REPLAY):
                coded = encode_words([w.encode() for w in part], self.ranks)
                self.known.update(zip(part, coded, strict=True))
        known = self.known.__getitem__
        for words in split:
            yield b"".join(map(known, words))


def corpora(texts: list[str], size: int = CORPUS) -> Iterator[list[str]]:
    """Consecutive texts, or words, of about ``size`` characters."""
    part, chars = [], 0
    for t in texts:
        if part and chars + len(t) > size:
            yield part
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    if part:
        yield part


class Codec:
    """Encoding and decoding columns for one vocabulary, read once on the driver."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        shared = spark.sparkContext.broadcast(Ranks(path, pattern))  # as large as the vocabulary

        @F.pandas_udf("binary")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = Encoder(shared.value)
            for batch in batches:
                for part in corpora(batch.tolist()):
                    yield pd.Series(list(encoder(part)), dtype=object)

        @F.pandas_udf("binary")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            token = shared.value.tokens.__getitem__
            for batch in batches:
                yield pd.Series(
                    [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in batch],
                    dtype=object,
                )

        @F.pandas_udf("ids binary, decoded binary")
        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encoder = Encoder(shared.value)
            token = shared.value.tokens.__getitem__
            for batch in batches:
                for part in corpora(batch.tolist()):
                    ids = list(encoder(part))
                    back = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]
                    yield pd.DataFrame({"ids": ids, "decoded": back}, dtype=object)

        @F.pandas_udf("ids binary, same boolean")
        def checked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            encoder = Encoder(shared.value)
            token = shared.value.tokens.__getitem__
            for batch in batches:
                for part in corpora(batch.tolist()):
                    ids = list(encoder(part))
                    same = [
                        b"".join(map(token, np.frombuffer(x, "<u4").tolist())) == t.encode()
                        for x, t in zip(ids, part, strict=True)
                    ]
                    yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "same": same})

        self._encode, self._decode, self._both, self._checked = encode, decode, both, checked

    def encode(self, text: str = "text") -> Column:
        """Packed ids of a text column."""
        return self._encode(text_of(text))

    def decode(self, ids: str = "ids") -> Column:
        """Bytes of packed ids; nulls count as no ids."""
        return self._decode(F.coalesce(F.col(ids), F.lit(b"")))

    def round_trip(self, text: str = "text") -> Column:
        """Struct of packed ids and the bytes that they decode to, in one pass of a task."""
        return self._both(text_of(text))

    def checked(self, text: str = "text") -> Column:
        """Struct of packed ids and whether they decode to the text."""
        return self._checked(text_of(text))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, n_tokens and the bytes that the ids decode to."""
    codec = Codec(docs.sparkSession, path, pattern)
    coded = docs.select("doc_id", codec.round_trip().alias("coded"))
    return coded.select(
        "doc_id",
        "coded.ids",
        (F.octet_length("coded.ids") / 4).cast("bigint").alias("n_tokens"),
        "coded.decoded",
    )
