"""Removal of long strings that occur more than once, by suffix arrays over what repeats.

A string of ``length`` bytes contains ``length - GRAM + 1`` shorter ones; the one with the
lowest hash is its anchor. Equal strings have equal anchors at the same place, so strings
that start next to each other share few anchors, and only rows of anchors are shuffled.
Each row has the range of starts whose anchor it is, and the digest of all bytes in their
strings. Rows alike in anchor and digest repeat as a whole. Where only the anchor is
alike, one row for each digest goes on: its bytes, joined with what overlaps in the same
document, are a segment. Segments that share anchors form families.

The segments of a family are one text. Its suffix array (linear grouping construction)
brings equal strings together: a suffix whose neighbour shares its first ``length`` bytes
starts a repeated string. Families larger than ``BLOCK`` bytes do not fit a task; they go
on as the surroundings of one anchor at a time, equal strings having equal anchors. Where
a single anchor has more than ``BLOCK`` bytes of different surroundings, its strings are
counted by their digests instead, which is exact as well.

Strings are bytes of UTF-8 and never cross documents. Null texts count as empty. Rows with
equal ids are documents of their own, so the copies of a repeated row lose what they share.
Documents shorter than ``length`` keep everything. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.llm.common import ROW, settle, text_of, with_row
from freshhaul.llm.components import components
from freshhaul.llm.shingles import BACK, BASE, mix, powers
from freshhaul.llm.suffix_array import suffix_array

LENGTH = 400
#: Bytes of an anchor.
GRAM = 128
#: Bytes hashed at once; a longer document is taken in overlapping parts.
PIECE = 1 << 20
#: Bytes of segments that one suffix array is built of.
BLOCK = 1_000_000


def doc_key() -> Column:
    """Number of a document, from the key of its row."""
    return F.xxhash64(*ROW).alias("doc")



def rolling(codes: np.ndarray) -> Callable[[np.ndarray, int | np.ndarray], np.ndarray]:
    """Hashes of strings of ``codes`` by start and length."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(77)) * powers(n, BASE), out=sums[1:])
    back = powers(n, BACK)
    return lambda at, size: mix((sums[at + size] - sums[at]) * back[at])


def parts(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces of consecutive (document, from, to); each string lies in exactly one part."""
    piece, total = [], 0
    for i, size in enumerate(sizes):
        for a in range(0, max(1, size - length + 1), PIECE):
            b = min(size, a + PIECE + length - 1)
            if total and total + b - a > PIECE:
                yield piece
                piece, total = [], 0
            piece.append((i, a, b))
            total += b - a
    if piece:
        yield piece


def anchors(codes: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First and last start of the strings of each anchor, anchor hash, digest of their bytes.

    ``ends``: for each position the end of its document.
    """
    none = np.empty(0, np.int64)
    n = len(codes)
    width, starts = length - gram + 1, n - length + 1
    if starts <= 0:
        return none, none, none, none
    of = rolling(codes)
    grams = of(np.arange(n - gram + 1), gram)
    # The lowest hash, the leftmost of equal ones: the position is in the low bits.
    low = np.uint64(24)
    tagged = ((grams >> low) << low) | np.arange(len(grams), dtype=np.uint64)
    fill = np.full(-len(tagged) % width + width, np.uint64(2**64 - 1))
    grid = np.concatenate([tagged, fill]).reshape(-1, width)
    onward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:starts], onward[width - 1 : width - 1 + starts])
    s = np.flatnonzero(np.arange(starts) + length <= ends[:starts])
    if not len(s):
        return none, none, none, none
    at = (least[s] & np.uint64(2**24 - 1)).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)
    heads = np.flatnonzero(new)
    first, last, at = s[heads], s[np.append(heads[1:], len(s)) - 1], at[heads]
    shape = mix((last - first).astype(np.uint64) * np.uint64(1 << 20) + (at - first).astype(np.uint64))
    whole = mix(of(first, last - first + length) + shape)
    return first, last, grams[at].view(np.int64), whole.view(np.int64)


def _scan(length: int, gram: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            docs = batch["doc"].to_numpy(np.int64)
            for piece in parts([len(r) for r in raw], length):
                sizes = np.array([b - a for _, a, b in piece])
                codes = np.frombuffer(b"".join(raw[i][a:b] for i, a, b in piece), np.uint8)
                bounds = np.cumsum(sizes)
                first, last, key, digest = anchors(codes, np.repeat(bounds, sizes), length, gram)
                part = np.searchsorted(bounds, first, "right")
                shift = np.array([a for _, a, _ in piece]) - (bounds - sizes)
                yield pd.DataFrame(
                    {
                        "doc": docs[np.array([i for i, _, _ in piece])[part]],
                        "first": first + shift[part],
                        "last": last + shift[part],
                        "anchor": key,
                        "digest": digest,
                    }
                )

    return run


def repeated_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of anchors that occur more than once, and whether all their bytes do.

    ``mixed``: the anchor has rows that differ; ``one``: the first row of its digest.
    """
    source = with_row(docs, text_of().alias("text")).select(doc_key(), "text")
    rows = source.mapInPandas(
        _scan(length, gram), "doc bigint, first bigint, last bigint, anchor bigint, digest bigint"
    )
    every = (Window.unboundedPreceding, Window.unboundedFollowing)
    by_anchor = Window.partitionBy("anchor").rowsBetween(*every)
    by_digest = Window.partitionBy("anchor", "digest")
    return (
        rows.withColumn("alike", F.count("*").over(by_anchor))
        .withColumn("mixed", F.min("digest").over(by_anchor) != F.max("digest").over(by_anchor))
        .filter("alike > 1")
        .withColumn("whole", F.count("*").over(by_digest.rowsBetween(*every)) > 1)
        .withColumn("one", F.row_number().over(by_digest.orderBy("doc", "first")) == 1)
        .drop("alike")
    )


def merged(spans: DataFrame, *keep: Column) -> DataFrame:
    """Spans (doc, start, stop) of a document joined where they overlap or touch."""
    order = Window.partitionBy("doc").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spans.withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy("doc", "island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), *keep)
        .drop("island")
    )


def repeated_starts(
    segments: list[bytes], docs: list[int], at: list[int], length: int
) -> list[np.ndarray]:
    """Starts of strings of ``length`` bytes, in each segment, that occur elsewhere too.

    A segment is the bytes of document ``docs[i]`` from ``at[i]`` on. Segments may
    overlap: a string is repeated only if it stands at two places of the documents.
    """
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments), np.uint8).astype(np.int64) + 1
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[begins[1:] - 1] = 0  # between segments, below every byte
    ends = np.repeat(begins + sizes, sizes + 1)[: len(text)]
    order = suffix_array(text)
    order = order[order + length <= ends[order]]
    none = [order[:0]] * len(segments)
    if not len(order):
        return none
    head = rolling(text)(order, length)
    of = np.searchsorted(begins, order, "right") - 1
    _, number = np.unique(np.array(docs, np.int64), return_inverse=True)
    offset = np.array(at, np.int64)[of] + order - begins[of]
    place = (number[of] << 40) + offset
    # Neighbours with the same first bytes are a run; it counts if its places differ.
    heads = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
    differ = np.minimum.reduceat(place, heads) != np.maximum.reduceat(place, heads)
    found = np.repeat(differ, np.diff(np.append(heads, len(order))))
    starts = np.sort(order[found])
    if not len(starts):
        return none
    of = np.searchsorted(begins, starts, "right") - 1
    parts = np.split(starts - begins[of], np.searchsorted(of, np.arange(1, len(segments))))
    return parts


def runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans covered by strings of ``length`` at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(x[0]), int(x[-1]) + length) for x in np.split(starts, cut)]


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Maximal spans (doc, start, stop) of each document covered by repeated strings."""
    rows = settle(repeated_anchors(docs, length, gram), "repeat-anchors")
    whole = rows.filter("whole").select("doc", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))

    ranges = rows.filter("mixed AND one").select(
        "doc", "anchor", "first", "last", F.col("first").alias("start"), (F.col("last") + length).alias("stop")
    )
    kept = F.collect_list(F.struct("anchor", "first", "last")).alias("ranges")
    node = F.xxhash64("doc", "start")
    segments = settle(merged(ranges, kept).withColumn("node", node), "repeat-segments")
    shared = segments.select("node", F.explode("ranges").alias("r")).select("node", "r.anchor")
    least = F.min("node").over(Window.partitionBy("anchor"))
    links = shared.select(F.col("node").alias("a"), least.alias("b"))
    family = components(links, "repeat-families").withColumnRenamed("node", "member")
    placed = segments.join(family, F.col("node") == F.col("member"), "left").select(
        "doc", "start", "stop", "ranges", F.coalesce("root", "node").alias("root")
    )
    weighed = placed.join(
        placed.groupBy("root").agg(F.sum(F.col("stop") - F.col("start")).alias("weight")), "root"
    )
    total = segments.agg(F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0))).first()[0]
    shared = max(1, 2 * total // block)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shared // 4)
    columns = ["doc", "start", "stop", "bucket", "first", "last"]
    none = F.lit(-1).cast("bigint")  # not null: null numbers inside arrays reach Python as floats
    families = weighed.filter(F.col("weight") <= block).select(
        "doc", "start", "stop",
        F.pmod(F.xxhash64("root"), F.lit(shared)).alias("bucket"),
        none.alias("first"), none.alias("last"),
    )
    alone = weighed.filter(F.col("weight") > block).select("doc", F.explode("ranges").alias("r")).select(
        "doc", "r.anchor", F.col("r.first").alias("start"), (F.col("r.last") + length).alias("stop"),
        "r.first", "r.last",
    )
    of_anchor = alone.groupBy("anchor").agg(F.sum(F.col("stop") - F.col("start")).alias("weight"))
    by_anchor = alone.join(of_anchor, "anchor").withColumn(
        "bucket",
        F.when(
            F.col("weight") <= block, shared + F.pmod(F.xxhash64("anchor"), F.lit(4 * shared))
        ).otherwise(none),
    )
    wanted = settle(
        families.select(*columns)
        .union(by_anchor.select(*columns))
        .groupBy("doc")
        .agg(F.collect_list(F.struct(*columns[1:])).alias("segments")),
        "repeat-wanted",
    )

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, found in zip(batch["doc"], batch["text"], batch["segments"], strict=True):
                raw = text.encode()
                for s in found:
                    if s["bucket"] >= 0:
                        out.append((doc, s["start"], int(s["bucket"]), raw[s["start"] : s["stop"]]))
            yield pd.DataFrame(out, columns=["doc", "start", "bucket", "bytes"])

    def search(group: pd.DataFrame) -> pd.DataFrame:
        found = repeated_starts(group["bytes"].tolist(), group["doc"].tolist(), group["start"].tolist(), length)
        return pd.DataFrame(
            [
                (doc, start + a, start + b)
                for doc, start, starts in zip(group["doc"], group["start"], found, strict=True)
                for a, b in runs(starts, length)
            ],
            columns=["doc", "start", "stop"],
        )

    def heads(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, text, found in zip(batch["doc"], batch["text"], batch["segments"], strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                for s in found:
                    if s["bucket"] >= 0:
                        continue
                    at = np.arange(s["first"], s["last"] + 1)
                    string = rolling(raw[s["start"] : s["stop"]])(at - s["start"], length)
                    yield pd.DataFrame({"doc": doc, "start": at, "string": string.view(np.int64)})

    texts = with_row(docs, text_of().alias("text")).select(doc_key(), "text").join(wanted, "doc")
    of_family = (
        texts.mapInPandas(cut, "doc bigint, start bigint, bucket bigint, bytes binary")
        .repartition(tasks, "bucket")  # a number, so that small partitions are not joined
        .groupBy("bucket")
        .applyInPandas(search, "doc bigint, start bigint, stop bigint")
    )
    found = whole.union(of_family)
    large = wanted.filter(F.exists("segments", lambda s: s["bucket"] < 0))
    if not large.isEmpty():
        strings = (
            with_row(docs, text_of().alias("text"))
            .select(doc_key(), "text")
            .join(large, "doc")
            .mapInPandas(heads, "doc bigint, start bigint, string bigint")
        )
        twice = strings.groupBy("string").agg(F.count("*").alias("n")).filter("n > 1")
        found = found.union(
            strings.join(twice, "string").select("doc", "start", (F.col("start") + length).alias("stop"))
        )
    return merged(found)


def without_repeats(docs: DataFrame, length: int = LENGTH, **options: int) -> DataFrame:
    """doc_id, bytes of the text, maximal removed ``spans`` in order, and the bytes kept."""
    spans = (
        repeated_spans(docs, length, **options)
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )
    source = with_row(docs, F.col("doc_id"), text_of().cast("binary").alias("bytes")).select(
        doc_key(), "doc_id", "bytes"
    )
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    both = source.join(settle(spans, "repeat-spans"), "doc", "left").select(
        "doc_id", "bytes", F.coalesce("spans", none).alias("spans")
    )
    size = F.octet_length("bytes").cast("bigint")
    before = F.transform("spans", lambda s: s["stop"])
    from_ = F.concat(F.array(F.lit(0).cast("bigint")), before)
    upto = F.concat(F.transform("spans", lambda s: s["start"]), F.array(size))
    gaps = F.arrays_zip(from_.alias("a"), upto.alias("b"))
    piece = lambda g: F.substring(
        F.col("bytes"), (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")
    )
    kept = F.aggregate(gaps, F.lit(b""), lambda acc, g: F.concat(acc, piece(g)))
    return both.select(
        "doc_id",
        size.alias("n_bytes"),
        "spans",
        F.when(F.size("spans") == 0, F.col("bytes")).otherwise(kept).alias("kept"),
    )
