"""Document quality by supervised subword embeddings.

Words and their character n-grams (word boundaries included) hash into one table of
vectors. A document is the mean of its vectors, a softmax over the classes sits on top,
and both are learned together by stochastic gradient descent in numpy.

Fitting takes at most ``sample`` labelled rows, those with the smallest digest of their
id; the bound holds at any size of the input, and the one task that fits has no more than
that. Everything else covers all rows: because the model is linear above the mean, each
bucket folds into one number per class, so a task scores whole texts with a table of fixed
size and one pass over the characters.

Null and empty texts have no features and score by the bias alone. Labels that are null
or contradict each other within a ``doc_id`` are left out; repeated labels count once, and
labels without a document are ignored. Without labels of both classes the score is the
share of the known class, 0.5 without any. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshhaul.llm.common import text_of

BUCKETS = 1 << 17
GRAMS = (3, 4)
DIM = 8
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 4_000
#: Documents shown to the model, one at a time, whatever the number of labelled rows.
STEPS = 20_000
RATE = 0.2
SEED = 11
THRESHOLD = 0.3
#: Characters hashed at once; a longer text is one piece by itself.
PIECE = 1 << 18

#: Weight of a word that repeats the one before it, against an n-gram; its bucket is 0.
REPEATED = 4

ODD = np.uint64(0x9E3779B97F4A7C15)
SALT = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5CB9243F1E2A1B7), np.uint64(0xC2B2AE3D27D4EB4F))


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def bucket_of(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * ODD
    return (h >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word and n-gram, and the index of its text, in no set order."""
    # Each text begins with the space before it, so a feature belongs to the text it starts in.
    codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
    values = np.where(gap, 32, codes).astype(np.uint64)
    found, owners = [], []
    for k, n in enumerate(GRAMS):
        last = len(codes) - n + 1
        if last <= 0:
            continue
        h = np.full(last, SALT[k % len(SALT)])
        ok = np.ones(last, bool)
        for j in range(n):
            h = h * ODD + values[j : j + last]
            if 0 < j < n - 1:
                ok &= ~gap[j : j + last]
        at = np.flatnonzero(ok[: len(owner)])
        found.append(bucket_of(h[at]))
        owners.append(owner[at])
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    if len(starts):
        base = 0x100000001B3
        sums = np.concatenate(
            [np.zeros(1, np.uint64), np.cumsum((values + np.uint64(1)) * powers(len(values), base))]
        )
        # The sum over a word is the sum of the word alone times a power of its start.
        back = powers(len(values), pow(base, -1, 1 << 64))
        words = (sums[ends] - sums[starts]) * back[starts]
        found.append(bucket_of(words ^ SALT[2]))
        owners.append(owner[starts - 1])
        # A word said twice running counts as that besides, whatever the word is.
        again = np.flatnonzero(words[1:] == words[:-1]) + 1
        again = again[owner[starts[again] - 1] == owner[starts[again - 1] - 1]]
        found.append(np.zeros(REPEATED * len(again), np.int64))
        owners.append(np.repeat(owner[starts[again] - 1], REPEATED))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``PIECE`` characters with the index of the first."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def fit(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    steps: int = STEPS,
    rate: float = RATE,
    seed: int = SEED,
) -> tuple[np.ndarray, float]:
    """Log odds of class 1 that each bucket adds to the mean, and the bias.

    ``bags``: buckets and their shares of the document; shares sum to 1, or are empty.
    """
    total = len(labels)
    ones = int(labels.sum())
    prior = (ones + 0.5) / (total + 1.0)
    table = np.zeros(BUCKETS, np.float32)
    if ones in (0, total):
        return table, float(np.log(prior / (1 - prior)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out = rng.normal(0, 1, (2, DIM))
    bias = np.log(np.array([1 - prior, prior]))
    done = 0
    while done < steps:
        for i in rng.permutation(total)[: steps - done]:
            buckets, shares = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            hidden = shares @ vectors[buckets] if len(buckets) else np.zeros(DIM)
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            back = p @ out
            out -= step * np.outer(p, hidden)
            bias -= 0.1 * step * p
            # Shares are of the order of 1 / features: scaled so that a step moves the mean by it.
            if len(buckets):
                vectors[buckets] -= (step / (shares @ shares)) * shares[:, None] * back
    table = (vectors @ (out[1] - out[0])).astype(np.float32)
    return table, float(bias[1] - bias[0])


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    found, _ = features([text])
    buckets, counts = np.unique(found, return_counts=True)
    return buckets, counts / max(1, counts.sum())


def _bags(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [bag(t) for t in batch["text"]]
        yield pd.DataFrame(
            {
                "place": batch["place"],
                "label": batch["label"],
                "buckets": [b.astype(np.int32) for b, _ in rows],
                "shares": [s.astype(np.float32) for _, s in rows],
            }
        )


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """One row for each labelled id whose labels agree: doc_id and label."""
    return (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("high"))
        .filter("label = high AND label IN (0, 1)")
        .select("doc_id", "label")
    )


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, steps: int = STEPS
) -> tuple[np.ndarray, float]:
    """Table and bias fitted on at most ``sample`` labelled rows, in one task."""
    place = F.md5(F.col("doc_id").cast("string"))
    chosen = known_labels(labels, label).orderBy(place, "doc_id").limit(sample)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    bags = (
        rows.select(F.concat(place, F.md5("text")).alias("place"), "label", "text")
        .mapInPandas(_bags, "place string, label int, buckets array<int>, shares array<float>")
        .orderBy("place")
        .limit(sample)  # an id may have several rows
    )

    def learn(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, marks = [], []
        for batch in batches:
            found += zip(batch["buckets"], batch["shares"], strict=True)
            marks += batch["label"].tolist()
        table, bias = fit(found, np.array(marks, np.int64), steps)
        yield pd.DataFrame({"vectors": [table.tobytes()], "bias": [bias]})

    model = bags.repartition(1).mapInPandas(learn, "vectors binary, bias double").first()
    return np.frombuffer(bytes(model["vectors"]), np.float32), model["bias"]


def score_texts(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 of each text."""
    out = np.full(len(texts), bias)
    for first, part in pieces(texts):
        buckets, owner = features(part)
        sums = np.bincount(owner, table[buckets], len(part))
        counts = np.bincount(owner, minlength=len(part))
        out[first : first + len(part)] += sums / np.maximum(counts, 1)
    return 1.0 / (1.0 + np.exp(-out))


def scorer(docs: DataFrame, model: tuple[np.ndarray, float]) -> Column:
    """Column with the score of each whole text of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, at any input size

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, bias = shared.value
        for batch in batches:
            yield pd.Series(score_texts(batch.tolist(), table, bias))

    return score(text_of())


def held_out() -> Column:
    """Whether the id belongs to the fifth that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score and predicted, the model learnt from the other ids."""
    model = train(docs, labels.filter(~held_out()))
    scored = docs.withColumn("score", scorer(docs, model))
    return scored.withColumn("held_out", held_out()).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged."""
    names = docs.columns
    model = train(docs, labels.filter(~held_out()))
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        scorer(docs, model).alias("score"),
    )
    return rows.filter(F.col("score") >= THRESHOLD).select("row.*")
