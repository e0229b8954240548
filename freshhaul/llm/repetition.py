"""Quality rules on repetition, from a suffix array over the words of each document.

The words of a piece of documents are ranked by prefix doubling: after three rounds equal
ranks mean equal runs of eight words. Only suffixes that repeat within their document go
on, so most of the text drops out there. The order of what is left, with the length of the
longest common prefix of neighbours, is cut into intervals, the maximal repeats: strings of
words that occur twice and cannot be made longer on either side without losing an
occurrence. The union of their spans and the longest of them decide.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
return. Null and empty texts have no words. Every text is taken whole, repeats are never
sought across documents. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.llm.common import WORD, text_of

WINDOW = 8
#: Characters ranked together; a longer text is a piece by itself.
PIECE = 1 << 20
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Base rules, and the limits of the method.

    ``covered``: percent of the words inside maximal repeats of ``WINDOW`` words or more;
    ``longest``: percent of the words that the longest repeat may have, a repeat of up to
    ``short`` words being allowed in any text.
    """

    least_words: int = 20
    repeated: int = 30
    covered: int = 25
    longest: int = 20
    short: int = 50


def suffix_ranks(words: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Suffixes that share ``WINDOW`` words with another one of their document.

    ``words``: word numbers, documents one after the other; ``left``: words from each
    position to the end of its document; a suffix ends with its document. Returns the
    suffixes in suffix order within each document, the ranks after each round of
    doubling, and for each suffix the document, as the position of its end.
    """
    n = len(words)
    end = np.arange(n) + left
    # A rank is one more than the suffixes in lower classes of (document, first words), so
    # that a class can split upwards without touching the next; 0 stands for the end.
    _, number, sizes = np.unique(
        end * (int(words.max()) + 1) + words, return_inverse=True, return_counts=True
    )
    rank = (np.cumsum(sizes) - sizes + 1)[number]
    ranks, span = [rank], 1
    active = np.arange(n)
    while len(active):
        follow = np.where(left[active] > span, rank[np.minimum(active + span, n - 1)], 0)
        key = rank[active].astype(np.int64) * (n + 2) + follow
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        first = np.ones(len(order), bool)
        first[1:] = sorted_key[1:] != sorted_key[:-1]
        # Classes keep their number and split upwards: the rank is that of the class plus
        # the number of its members that sort lower.
        old = rank[active][order]
        head = np.ones(len(order), bool)
        head[1:] = old[1:] != old[:-1]
        places = np.arange(len(order))
        start = np.maximum.accumulate(np.where(head, places, 0))
        mine = np.maximum.accumulate(np.where(first, places, 0))
        new = rank.copy()
        new[active[order]] = old + (mine - start)
        rank, span = new, 2 * span
        ranks.append(rank)
        group = np.cumsum(first) - 1
        alone = np.bincount(group)[group] == 1
        again = np.zeros(n, bool)
        again[active[order[~alone]]] = True
        if span == WINDOW:
            kept = again
        active = np.flatnonzero(again)
        if span >= WINDOW and not len(active):
            break
    if span < WINDOW:
        kept = np.zeros(n, bool)
    found = np.flatnonzero(kept)
    return found[np.lexsort((rank[found], end[found]))], ranks, end


def common_prefixes(
    order: np.ndarray, ranks: list[np.ndarray], end: np.ndarray, left: np.ndarray
) -> np.ndarray:
    """Words that each suffix of ``order`` shares with the one before it; 0 across documents."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    same = end[a] == end[b]
    total = np.zeros(len(a), np.int64)
    limit = len(end) - 1
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        # Ranks of a round are equal exactly when as many words are, none beyond the end.
        fits = (end[order[:-1]] - a >= step) & (end[order[1:]] - b >= step) & same
        equal = fits & (ranks[level][np.minimum(a, limit)] == ranks[level][np.minimum(b, limit)])
        total += np.where(equal, step, 0)
        a, b = a + np.where(equal, step, 0), b + np.where(equal, step, 0)
    return np.concatenate([[0], total])


def maximal_repeats(
    order: np.ndarray, lcp: np.ndarray, words: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths in words of maximal repeats that cover all those of ``WINDOW`` or more.

    A suffix is handled once, in the longest of its intervals: its shorter repeats lie
    within. An interval whose occurrences all follow the same word is not maximal; what it
    covers is inside the occurrences of the repeat that begins with that word.
    """
    starts: list[int] = []
    lengths: list[int] = []
    earlier = np.maximum(order - 1, 0)
    begins = (order == 0) | (end[earlier] != end[order])
    before = np.where(begins, -1, words[earlier]).tolist()
    heights = lcp.tolist() + [0]
    at = order.tolist()
    stack: list[list] = []  # [length, word before, whether words before differ, own starts]
    for place, word in enumerate(before):
        after = heights[place + 1]
        if after and (not stack or stack[-1][0] < after):
            stack.append([after, word, word < 0, []])
        if not stack:
            continue
        top = stack[-1]
        top[2] = top[2] or word != top[1] or word < 0
        top[3].append(at[place])
        while stack and stack[-1][0] > after:
            length, word, differ, own = stack.pop()
            if length >= WINDOW and differ:
                starts += own
                lengths += [length] * len(own)
            if stack and stack[-1][0] >= after:
                stack[-1][2] = stack[-1][2] or differ or word != stack[-1][1]
            elif after:
                stack.append([after, word, differ, []])
    return np.array(starts, np.int64), np.array(lengths, np.int64)


def repeats(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Words covered by maximal repeats, and words of the longest one, for each text."""
    counts = np.array([len(t) for t in texts], np.int64)
    covered, longest = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if not counts.sum():
        return covered, longest
    numbers: dict[str, int] = {}
    words = np.fromiter(
        (numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, counts.sum()
    )
    bounds = np.cumsum(counts)
    left = np.repeat(bounds, counts) - np.arange(len(words))
    order, ranks, end = suffix_ranks(words, left)
    lcp = common_prefixes(order, ranks, end, left)
    edges = np.zeros(len(words) + 1, np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    starts, lengths = maximal_repeats(order, lcp, words, end)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    np.maximum.at(longest, owner[starts], lengths)
    inside = np.cumsum(edges[:-1]) > 0
    covered += np.bincount(owner[inside], minlength=len(texts))
    return covered, longest


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, longest_repeat bigint"
)


def _measure(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    find, symbol = re.compile(WORD).findall, re.compile(f"[{re.escape(SYMBOLS)}]")
    for batch in batches:
        texts = batch["text"].tolist()
        first = 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= PIECE):
                chars += len(texts[last])
                last += 1
            part = texts[first:last]
            split = [find(t) for t in part]
            covered, longest = repeats(split)
            dup = []
            for t in part:
                lines = [x for x in t.split("\n") if find(x)] if "\n" in t else []
                dup.append(len(lines) - len(set(lines)))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[first:last].astype("Int64").to_numpy(),
                    "n_words": [len(w) for w in split],
                    "word_chars": [sum(map(len, w)) for w in split],
                    "n_symbols": [len(symbol.findall(t)) for t in part],
                    "n_dup_lines": dup,
                    "n_repeat_words": covered,
                    "longest_repeat": longest,
                }
            )
            first = last


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each document.

    The words that maximal repeats of eight words or more cover are those inside
    eight-word windows that occur twice, so ``n_repeat_words`` is their number.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return source.mapInPandas(_measure, f"doc_id bigint, {COLUMNS}")


def repetition_rules(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """``measures`` with base_failed and kept."""
    x = limits or Limits()
    words, repeated, longest = F.col("n_words"), F.col("n_repeat_words"), F.col("longest_repeat")
    failed = (words < x.least_words) | (100 * repeated > x.repeated * words)
    fine = (100 * repeated <= x.covered * words) & (
        (longest <= x.short) | (100 * longest <= x.longest * words)
    )
    return measures(docs).withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
