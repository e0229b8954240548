"""URL verdicts from host and path rules, and from words found inside host names.

Rules come first: a rule fits its host and all subdomains of it where the path starts with
the rule's, and the longest decides. All other urls go to naive Bayes. Host labels are
split into words by Viterbi over unigram probabilities, so that names written in one piece
fall apart; words of the path are taken as they stand, digits as one token. Multinomial
naive Bayes then weighs the tokens.

Unigram counts are those of all path words of the table, next to a fixed list of words.
Naive Bayes learns on all urls: one is an example of class block when its segmented host
has a marking word of that list, of class allow otherwise. Both classes are smoothed by all
urls, and class block by the list, so that a rare word of it weighs from the start.

Both counts are exact tables with a row for each word or token. Distinct hosts, and
distinct pairs of host and path words, are dealt into blocks by hash. A block asks once for
each string that it needs, a join finds those that are in the table, and the block works
with what was found: what a task holds is bounded, and a string that all hosts have in
common is asked for once a block.

A null url, or one without ``://``, has an empty host and path and no tokens; naive Bayes
then decides by the shares of the classes. No urls: no rows. Only the url is read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshhaul.llm.common import settle

# Words of hosts that sell or advertise what a corpus should not hold: fixed values.
UNWANTED = (
    "ad ads adult advert adserver affiliate banner bet bets betting bingo bonus cash casino"
    " cheap cialis click coupon crack dating deals discount download escort farm free gambling"
    " hentai jackpot loan loans lottery mature meds nude offers pharmacy pill pills poker popup"
    " porn promo replica rich roulette sale sex sexy slots spam torrent track tracker tracking"
    " viagra vip warez webcam win winner xxx"
).split()
# Of these, words that mark a host by themselves; the others only add to a score.
MARKS = frozenset(
    "adult adserver ads affiliate bets betting bingo casino cheap cialis dating escort gambling"
    " hentai jackpot loans lottery meds nude pharmacy pill pills poker porn popup roulette sex sexy"
    " slots spam torrent tracker viagra warez webcam xxx".split()
)
#: Counters in each of two rows when counts are hashed, of which the lower count holds.
WORDS = 1 << 18
LONGEST = 24
#: Hosts, or pairs of host and path words, in a block; blocks of small tables.
BLOCK, BLOCKS = 1024, 32
#: Tokens that a class is credited with before any are counted, and the share of them
#: that comes from the fixed list in class block.
SMOOTH, LISTED = 20.0, 0.2
#: Times that a word of the fixed list counts in advance.
PRIOR = 5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


def rules(lines: list[str]) -> list[Rule]:
    """Rules from lines such as ``block example.com/en/``."""
    out = []
    for line in lines:
        verdict, place = line.split()
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), capitals, capitals.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(given: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(given, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, str(rule)).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


PART = r"[^\W\d_]+|\d+"


def path_words(path: str) -> list[str]:
    return [("0" if w.isdigit() else w) for w in re.findall(PART, path.lower())]


def _slots(word: str) -> tuple[int, int]:
    raw = word.encode()
    return crc32(raw) % WORDS, WORDS + crc32(raw, 0x5EED) % WORDS


class Segmenter:
    """Words of a host name by unigram Viterbi; ``counts``: two rows of hashed counters."""

    def __init__(self, counts: np.ndarray | dict[str, int], total: int) -> None:
        self.counts, self.total = counts, total
        self.known: dict[str, list[str]] = {}

    def count(self, word: str) -> int:
        a, b = _slots(word)
        return min(int(self.counts[a]), int(self.counts[b]))

    def cost(self, word: str) -> float:
        n = self.count(word)
        # An unknown word is less likely with each letter.
        return log(self.total) - (log(n) if n else log(10) * (1 - len(word)))

    def label(self, text: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            cost, start = min(
                (best[s] + self.cost(text[s:end]), s) for s in range(max(0, end - LONGEST), end)
            )
            best.append(cost)
            back.append(start)
        words, end = [], len(text)
        while end:
            words.append(text[back[end] : end])
            end = back[end]
        return words[::-1]

    def host(self, host: str) -> list[str]:
        words: list[str] = []
        for part in re.findall(PART, host):
            if part.isdigit():
                words.append("0")
                continue
            if part not in self.known:
                self.known[part] = self.label(part)
            words += self.known[part]
        return words


class ExactSegmenter(Segmenter):
    """The same by exact counts; a string that is not in ``counts`` is no word."""

    def count(self, word: str) -> int:
        return self.counts.get(word, 0)


def candidates(hosts: Iterable[str]) -> set[str]:
    """All strings that could be words of the hosts."""
    labels = {p for h in hosts for p in re.findall(PART, h) if not p.isdigit()}
    return {
        t[s:end] for t in labels for end in range(1, len(t) + 1) for s in range(max(0, end - LONGEST), end)
    }


def _counted(items: Callable[[pd.DataFrame], Iterable[tuple]], names: list[str]) -> Callable:
    """Task function: sums of ``(key.., n)`` of a batch."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for *key, n in items(batch):
                counts[tuple(key)] += n
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=names, dtype=object)

    return run


def word_counts(kinds: DataFrame) -> tuple[DataFrame, int]:
    """Exact counts of the path words of all urls, and of the fixed words; their sum."""

    def items(batch: pd.DataFrame) -> Iterator[tuple]:
        for words, n in zip(batch["words"], batch["n"], strict=True):
            for w in words.split():
                yield w, n

    found = kinds.mapInPandas(_counted(items, ["word", "n"]), "word string, n bigint")
    fixed = kinds.sparkSession.createDataFrame([(w, PRIOR) for w in UNWANTED], "word string, n bigint")
    counts = settle(found.union(fixed).groupBy("word").agg(F.sum("n").alias("n")), "url-words")
    return counts, int(counts.agg(F.sum("n")).first()[0])


def _by_blocks(
    items: DataFrame,
    key: list[str],
    asked: Callable[[pd.DataFrame], set[str]],
    table: DataFrame,
    answer: Callable[[pd.DataFrame, dict], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """``answer`` of each block of ``items``, given the values that ``table`` (word, value)
    has for the strings that the block asks for; strings not in the table are missing."""
    blocks = max(BLOCKS, items.count() // BLOCK)
    items = items.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(blocks)))

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        words = sorted(asked(block))
        return pd.DataFrame({"part": [block["part"].iloc[0]] * len(words), "word": words}, dtype=object)

    def solve(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return answer(block, dict(zip(found["word"], found["value"], strict=True)))

    wanted = items.groupBy("part").applyInPandas(ask, "part bigint, word string")
    found = wanted.join(table.toDF("word", "value"), "word")
    return items.groupBy("part").cogroup(found.groupBy("part")).applyInPandas(solve, schema)


def segmented(kinds: DataFrame) -> DataFrame:
    """Distinct hosts with their words, joined by spaces, and whether one of them marks."""
    counts, total = word_counts(kinds)

    def answer(block: pd.DataFrame, known: dict[str, int]) -> pd.DataFrame:
        split = ExactSegmenter(known, total)
        names = [split.host(h) for h in block["host"]]
        return pd.DataFrame(
            {
                "host": block["host"],
                "names": [" ".join(n) for n in names],
                "block": [int(not MARKS.isdisjoint(n)) for n in names],
            },
            dtype=object,
        )

    hosts = settle(kinds.select("host").distinct(), "url-hosts")
    schema = "host string, names string, block bigint"
    return settle(
        _by_blocks(hosts, ["host"], lambda b: candidates(b["host"]), counts, answer, schema), "url-names"
    )


def token_weights(kinds: DataFrame) -> tuple[DataFrame, float]:
    """Log odds of class block that each token adds, and those of a url without tokens."""

    def items(batch: pd.DataFrame) -> Iterator[tuple]:
        for tokens, block, n in zip(batch["tokens"], batch["block"], batch["n"], strict=True):
            for t in tokens.split():
                yield t, block, n

    counted = kinds.mapInPandas(
        _counted(items, ["token", "class", "n"]), "token string, class bigint, n bigint"
    )
    of_class = lambda k: F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(0))
    counts = settle(
        counted.groupBy("token").agg(of_class(0).alias("allow"), of_class(1).alias("block")), "url-tokens"
    )
    allow, block = (int(n or 0) for n in counts.agg(F.sum("allow"), F.sum("block")).first())
    urls, blocked = (int(n or 0) for n in kinds.agg(F.sum("n"), F.sum(F.col("n") * F.col("block"))).first())
    # Each class is smoothed by what all urls have; class block knows the list besides.
    every = (F.col("allow") + F.col("block")) / max(1, allow + block)
    fixed = F.when(F.col("token").isin(UNWANTED), 1 / len(UNWANTED)).otherwise(0.0)
    mixed = (1 - LISTED) * every + LISTED * fixed
    in_allow = (F.col("allow") + SMOOTH * every) / (allow + SMOOTH)
    in_block = (F.col("block") + SMOOTH * mixed) / (block + SMOOTH)
    weights = counts.select("token", (F.log(in_block) - F.log(in_allow)).alias("weight"))
    return weights, log((blocked + 1) / (urls - blocked + 1))


def kind_odds(kinds: DataFrame) -> DataFrame:
    """Log odds of class block for each pair of host and path words."""
    tokens = F.concat_ws(" ", "names", "words").alias("tokens")
    kinds = settle(
        kinds.join(segmented(kinds), "host").select("host", "words", "n", "block", tokens), "url-tokens-of"
    )
    weights, bias = token_weights(kinds)

    def answer(block: pd.DataFrame, known: dict[str, float]) -> pd.DataFrame:
        odds = [bias + sum(known[t] for t in tokens.split()) for tokens in block["tokens"]]
        return pd.DataFrame({"host": block["host"], "words": block["words"], "odds": odds}, dtype=object)

    schema = "host string, words string, odds double"
    asked = lambda b: {t for tokens in b["tokens"] for t in tokens.split()}
    return settle(_by_blocks(kinds, ["host", "words"], asked, weights, answer, schema), "url-odds")


def _words_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for paths in batches:
        yield pd.Series([" ".join(path_words(p)) for p in paths], dtype=object)


def url_verdicts(pages: DataFrame, given: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, odds (of class block by naive Bayes) and verdict."""
    host, path = host_and_path(F.col(url))
    parts = [host.alias("host"), F.pandas_udf(_words_of, "string")(path).alias("words")]
    kinds = settle(pages.select(*parts).groupBy("host", "words").agg(F.count("*").alias("n")), "url-kinds")
    row = F.struct(*[F.col(f"`{n}`") for n in pages.columns]).alias("row")
    judged = pages.select(row, *parts, path.alias("path")).join(kind_odds(kinds), ["host", "words"], "left")
    host, path, odds = F.col("judged.host"), F.col("judged.path"), F.col("judged.odds")
    rule, verdict = rule_of(given, host, path)
    by_method = F.when(odds > 0, "block").otherwise("allow")
    added = {"odds": odds, "host": host, "path": path, "rule": rule, "verdict": F.coalesce(verdict, by_method)}
    out = judged.select("row", F.struct("host", "path", "odds").alias("judged"))
    kept = [added.get(n, F.col(f"row.`{n}`")).alias(n) for n in pages.columns]
    return out.select(*kept, *[c.alias(n) for n, c in added.items() if n not in pages.columns])
