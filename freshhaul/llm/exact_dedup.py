"""Exact duplicates through a cuckoo-filter index of text digests.

Two texts are equal when nothing but white space tells them apart. A task keeps the
digests that it has met in a cuckoo filter: fingerprints in buckets of four, each slot
beside the whole digest, against which every hit is verified. Digests can be inserted
and deleted; when an insertion finds no room after many moves, the filter doubles and is
filled again from the stored digests.

The index is built twice: over what each scan task reads, so that a group of copies with
a third of all rows leaves each task as one row, and over the digests dealt out by value.

Null texts count as empty, and all empty texts are equal. A null ``doc_id`` comes after
all others. Of rows alike in text and ``doc_id`` exactly one stays. No rows in, no rows out.
Only ``doc_id`` and ``text`` are read; other columns neither matter nor clash.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.llm.common import ROW, SPACES, keep_rows, settle, text_of, with_row

SLOTS = 4
MOVES = 500
#: Digests after which a scan task passes on what it has and starts afresh.
FLUSH = 200_000

GROUP = "digest string, copies bigint, n_chars bigint, doc_id bigint, row_file string, row_index bigint"


class CuckooIndex:
    """Cuckoo filter of hexadecimal digests with the digests and their values beside it."""

    def __init__(self, buckets: int = 256, moves: int = MOVES) -> None:
        self.moves = moves
        self.size = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1  # buckets: a power of two
        self.prints = [0] * (buckets * SLOTS)
        self.content: list[tuple | None] = [None] * (buckets * SLOTS)
        self.pick = random.Random(7)

    def _places(self, digest: str) -> tuple[int, int, int]:
        mark = int(digest[:4], 16) or 1
        first = int(digest[4:20], 16) & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def _slot(self, digest: str) -> int:
        mark, first, second = self._places(digest)
        prints, content = self.prints, self.content
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                # A fingerprint is only a hint: the stored digest decides.
                if prints[slot] == mark and content[slot][0] == digest:
                    return slot
        return -1

    def get(self, digest: str) -> tuple | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.content[slot][1]

    def put(self, digest: str, value: tuple) -> None:
        """Insert a digest, or replace the value of one that is present."""
        slot = self._slot(digest)
        if slot >= 0:
            self.content[slot] = (digest, value)
            return
        self.size += 1
        homeless = self._insert((digest, value))
        while homeless is not None:
            homeless = self._grow(homeless)

    def _insert(self, entry: tuple) -> tuple | None:
        """None, or the entry left without a place after the allowed moves."""
        mark, bucket, other = self._places(entry[0])
        for at in (bucket, other):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.content[slot] = mark, entry
                    return None
        for _ in range(self.moves):
            slot = bucket * SLOTS + self.pick.randrange(SLOTS)
            mark, self.prints[slot] = self.prints[slot], mark
            entry, self.content[slot] = self.content[slot], entry
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.content[slot] = mark, entry
                    return None
        return entry

    def _grow(self, homeless: tuple) -> tuple | None:
        """Double the filter and fill it from the stored digests."""
        entries = [x for x in self.content if x is not None] + [homeless]
        buckets = 2 * (self.mask + 1)
        while buckets <= 2**40:
            self._clear(buckets)
            if all(self._insert(x) is None for x in entries):
                return None
            buckets *= 2
        raise ValueError("digests do not differ in their first 80 bits")

    def delete(self, digest: str) -> bool:
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.prints[slot], self.content[slot] = 0, None
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple]:
        return (x for x in self.content if x is not None)


def _first(n_chars: int, doc_id: int | None, file: str, index: int) -> tuple:
    """Sorts the row that stays before its copies."""
    return -n_chars, doc_id is None, 0 if doc_id is None else doc_id, file, index


def _rows(index: CuckooIndex) -> pd.DataFrame:
    out = [
        (d, copies, -best[0], None if best[1] else best[2], best[3], best[4])
        for d, (copies, best) in index.items()
    ]
    frame = pd.DataFrame(
        out, columns=["digest", "copies", "n_chars", "doc_id", "row_file", "row_index"]
    )
    return frame.astype({"doc_id": "Int64"})


def collapse(flush: int | None) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Task function: one row for each digest of the task with its copies and best row."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = CuckooIndex()
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for digest, copies, n, doc_id, file, at in zip(
                batch["digest"],
                batch["copies"],
                batch["n_chars"],
                [None if x is pd.NA else int(x) for x in ids],
                batch["row_file"],
                batch["row_index"],
                strict=True,
            ):
                best = _first(int(n), doc_id, file, int(at))
                if (found := index.get(digest)) is not None:
                    copies, best = copies + found[0], min(best, found[1])
                index.put(digest, (int(copies), best))
            if flush and index.size >= flush:
                yield _rows(index)
                index = CuckooIndex()
        yield _rows(index)

    return run


def digests(docs: DataFrame) -> DataFrame:
    """Digest of the text without white space, and code points of the original text."""
    bare = F.translate(text_of(), SPACES, "")
    return with_row(
        docs,
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(bare.cast("binary"), 256).alias("digest"),
        F.length(text_of()).cast("bigint").alias("n_chars"),
    )


def groups(hashed: DataFrame, flush: int = FLUSH) -> DataFrame:
    """One row for each digest: copies, and length, id and key of the row that stays."""
    columns = ["digest", "copies", "n_chars", "doc_id", *ROW]
    ones = hashed.withColumn("copies", F.lit(1).cast("bigint")).select(*columns)
    partial = ones.mapInPandas(collapse(flush), GROUP)
    return partial.repartition("digest").mapInPandas(collapse(None), GROUP)


def withdraw(index: DataFrame, removed: DataFrame) -> DataFrame:
    """The live digests after each row of ``removed`` has taken one copy of its digest away.

    A digest without copies is deleted from the filter. Digests that the index does not
    hold change nothing. Returns digest and copies left.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        live = CuckooIndex()
        for batch in batches:
            for digest, copies, less in zip(
                batch["digest"], batch["copies"], batch["less"], strict=True
            ):
                live.put(digest, (int(copies),))
                if less >= copies:
                    live.delete(digest)
                elif less:
                    live.put(digest, (int(copies - less),))
        yield pd.DataFrame(
            [(d, v[0]) for d, v in live.items()], columns=["digest", "copies"]
        ).astype({"copies": "int64"})

    gone = removed.groupBy("digest").agg(F.count("*").alias("less"))
    both = index.select("digest", "copies").join(gone, "digest", "left").fillna(0, ["less"])
    return both.mapInPandas(run, "digest string, copies bigint")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its group of equal texts and whether it stays."""
    hashed = settle(digests(docs), "digests")
    found = settle(groups(hashed), "digest-groups").select(
        "digest",
        F.col("copies").alias("group_size"),
        F.col("doc_id").alias("keep_id"),
        F.col("row_file").alias("keep_file"),
        F.col("row_index").alias("keep_index"),
    )
    stays = (F.col("row_file") == F.col("keep_file")) & (
        F.col("row_index") == F.col("keep_index")
    )
    return hashed.join(found, "digest").withColumn("kept", stays)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    return keep_rows(docs, exact_groups(docs).filter(~F.col("kept")))
