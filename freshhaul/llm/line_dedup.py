"""Lines that many documents share, by sharded cuckoo filters over exact reference counts.

A line's key is the line without white space at its ends, A-Z lower-cased. The index counts
for each key in how many documents it stands. It is a table of exact counts by the 128-bit
digest of the key, dealt into shards by the first bits of the digest, and two cuckoo filters
for each shard: of the keys that are live, and of those that are common (in ``limit``
documents or more). Filters hold 16-bit fingerprints in buckets of four and support
insertion and deletion; one that overflows is built anew, larger, from the counted keys.

Documents are inserted or deleted in bulk. Their keys are counted with map-side combine, so
a line of a third of all documents is one row for each task, and each shard applies its
changes by itself: what the live filter does not know is new without a look at the counts,
what it knows is verified against them. A deletion takes back exactly what the insertion of
the same documents did, so the index stays reversible: keys without documents leave counts
and filters, keys that fall below the limit leave the filter of common ones.

To strip documents, their keys meet the filter of common keys of their shard, in salted
parts, so that no task gets all occurrences of one line; hits are verified against the exact
counts. Only documents that lose lines are split again.

Null or empty texts are one empty line. Empty keys are never common. Rows with equal ids are
documents of their own; a null ``doc_id`` is an id like others. A line that a document
repeats counts once. Lines and texts of any length pass whole. Columns other than ``doc_id``
and ``text`` are not read. No documents: no rows, and an index without keys.
"""

from __future__ import annotations

import random
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from freshhaul.llm.common import ROW, settle, text_of, with_row

BLANK = b" \t\n\x0b\x0c\r"
#: Documents from which on a key is common.
LIMIT = 10
#: Keys of a shard, about: what one task holds at once.
SHARD = 100_000
#: Parts of a shard whose lines are looked up apart.
SALTS = 8
SLOTS = 4
MOVES = 200

KEYS = "row_file string, row_index bigint, digest binary, lines array<int>"
INDEX = "bits int, shard int, digest binary, refs bigint, live binary, common binary"


class CuckooFilter:
    """Fingerprints of 64-bit hashes, four to a bucket; as bytes in a table."""

    def __init__(self, packed: bytes | None = None, keys: int = 0) -> None:
        self.pick = random.Random(11)
        if packed is None:
            self._clear(keys)
        else:
            self.slots = array("H", packed)
            self.mask = len(self.slots) // SLOTS - 1

    def _clear(self, keys: int) -> None:
        buckets = 1
        while buckets * SLOTS * 0.9 < keys:
            buckets *= 2
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))

    def packed(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = (key & 0xFFFF) or 1
        first = (key >> 16) & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 5) & self.mask)

    def put(self, key: int) -> bool:
        """False if there was no room: the filter must be built anew then."""
        mark, bucket, other = self._places(key)
        slots = self.slots
        for at in (bucket * SLOTS, other * SLOTS):
            for slot in range(at, at + SLOTS):
                if not slots[slot]:
                    slots[slot] = mark
                    return True
        for _ in range(MOVES):
            slot = bucket * SLOTS + self.pick.randrange(SLOTS)
            mark, slots[slot] = slots[slot], mark
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not slots[slot]:
                    slots[slot] = mark
                    return True
        return False

    def delete(self, key: int) -> None:
        """Take a key that was put before out again."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[slot] == mark:
                    self.slots[slot] = 0
                    return

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be present; false is certain."""
        mark = keys & np.uint64(0xFFFF)
        mark[mark == 0] = 1
        first = (keys >> np.uint64(16)) & np.uint64(self.mask)
        second = first ^ ((mark * np.uint64(0x5BD1E995) >> np.uint64(5)) & np.uint64(self.mask))
        slots = np.frombuffer(self.slots, np.uint16).reshape(-1, SLOTS)
        wanted = mark.astype(np.uint16)[:, None]
        return (slots[first] == wanted).any(1) | (slots[second] == wanted).any(1)


def filled(keys: Iterable[int], count: int) -> CuckooFilter:
    """A filter of the keys, as large as it takes; of keys alike more than twice a slot's room."""
    keys, room = list(keys), count
    while True:
        found = CuckooFilter(keys=room)
        if all(found.put(k) for k in keys):
            return found
        if room > 64 * count + 1024:
            raise ValueError("too many keys with one fingerprint and bucket")
        room = 2 * room + 1


def low_bits(digests: np.ndarray) -> np.ndarray:
    """The last 64 bits of 16-byte digests; shards use the first."""
    return np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2)[:, 1].astype(np.uint64)


def key_of(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # of bytes: A-Z alone


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
    names = [*ROW, "digest", "lines"]
    for batch in batches:
        of, digests, lines = [], [], []
        pending = 0
        for n, text in enumerate(batch.column("text").to_pylist()):
            places: dict[bytes, list[int]] = {}
            for i, line in enumerate(text.encode().split(b"\n")):
                key = key_of(line)
                if key:
                    places.setdefault(key, []).append(i)
            of += [n] * len(places)
            digests += map(digest, places)
            lines += places.values()
            pending += len(text)
            if pending > 1 << 24 or n == batch.num_rows - 1:
                at = pa.array(of, pa.int64())
                columns = [batch.column(c).take(at) for c in ROW] + [
                    pa.array(digests, kinds[2]), pa.array(lines, kinds[3])
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                of, digests, lines, pending = [], [], [], 0


def line_keys(docs: DataFrame) -> DataFrame:
    """Digest of each distinct key of each row of ``docs``, and the numbers of its lines."""
    return with_row(docs, text_of().alias("text")).mapInArrow(_keys, KEYS)


def shard_of(bits: int) -> F.Column:
    """Shard of a digest: its first bits."""
    high = F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("int")
    return F.shiftright(high, 24 - bits).cast("int")


def _update(limit: int, bits: int, afresh: bool) -> Callable[..., pd.DataFrame]:
    """Task function: the rows of one shard after its changes (digest, delta)."""

    def run(key: tuple, now: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        refs: dict[bytes, int] = {}
        live = common = None
        for digest, n, a, b in zip(now["digest"], now["refs"], now["live"], now["common"], strict=True):
            if digest is None:
                live, common = CuckooFilter(a), CuckooFilter(b)
            else:
                refs[bytes(digest)] = int(n)
        if afresh or live is None:
            low = dict(zip(refs, low_bits(list(refs)).tolist(), strict=True)) if refs else {}
            often = [k for d, k in low.items() if refs[d] >= limit]
            live, common = filled(low.values(), len(low) + len(changes)), filled(often, len(often))
        digests = [bytes(d) for d in changes["digest"]]
        keys = low_bits(digests) if digests else np.empty(0, np.uint64)
        # What the filter does not know is not in the table: it needs no look there.
        hits = live.has(keys).tolist()
        full_live = full_common = False
        for digest, key_, hit, delta in zip(
            digests, keys.tolist(), hits, changes["delta"].tolist(), strict=True
        ):
            before = refs.get(digest, 0) if hit else 0
            after = max(0, before + delta)
            if after:
                refs[digest] = after
            elif before:
                del refs[digest]
            if after and not before:
                full_live |= not live.put(key_)
            elif before and not after:
                live.delete(key_)
            if after >= limit > before:
                full_common |= not common.put(key_)
            elif before >= limit > after:
                common.delete(key_)
        if full_live or full_common:
            low = dict(zip(refs, low_bits(list(refs)).tolist(), strict=True))
            often = [k for d, k in low.items() if refs[d] >= limit]
            live = filled(low.values(), len(low)) if full_live else live
            common = filled(often, len(often)) if full_common else common
        none = [None] * len(refs)
        return pd.DataFrame(
            {
                "bits": np.full(len(refs) + 1, bits, np.int32),
                "shard": np.full(len(refs) + 1, key[0], np.int32),
                "digest": [None, *refs],
                "refs": pd.array([None, *refs.values()], "Int64"),
                "live": [live.packed(), *none],
                "common": [common.packed(), *none],
            }
        )

    return run


def _changed(index: DataFrame | None, keys: DataFrame, sign: int, limit: int, shard: int) -> DataFrame:
    spark = keys.sparkSession
    counts = keys.groupBy("digest").agg((F.count("*") * sign).alias("delta"))
    changes = settle(counts, "line-changes")
    bits = max(0, (changes.count() // shard).bit_length())
    afresh = index is None
    if index is None:
        index = spark.createDataFrame([], INDEX)
    else:
        live, old = index.agg(F.count("refs"), F.coalesce(F.max("bits"), F.lit(0))).first()
        bits = max(bits, (live // shard).bit_length(), old)
        if bits > old:  # shards are split: their filters are built anew
            index = index.filter("digest IS NOT NULL").withColumn("shard", shard_of(bits))
            afresh = True
    both = index.groupBy("shard").cogroup(changes.withColumn("shard", shard_of(bits)).groupBy("shard"))
    return settle(both.applyInPandas(_update(limit, bits, afresh), INDEX), "line-index")


def insert(
    index: DataFrame | None, keys: DataFrame, limit: int = LIMIT, shard: int = SHARD
) -> DataFrame:
    """The index with the documents of ``keys`` added; None is an index without keys."""
    return _changed(index, keys, 1, limit, shard)


def delete(index: DataFrame, keys: DataFrame, limit: int = LIMIT, shard: int = SHARD) -> DataFrame:
    """The index as it was before the documents of ``keys`` were inserted."""
    return _changed(index, keys, -1, limit, shard)


def _look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that the filter of their shard knows; the filter comes before them."""
    shard, common = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        filters = batch.column("common")
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(shards)], strict=True):
            if a == b:
                continue
            if shards[a] != shard:
                shard, common = shards[a], None
            while a < b and filters[int(a)].is_valid:
                common = CuckooFilter(filters[int(a)].as_py())
                a += 1
            if common is None or a == b:
                continue
            rows = batch.slice(a, b - a)
            hits = common.has(low_bits(rows.column("digest").to_pylist()))
            if hits.any():
                found = rows.filter(pa.array(hits))
                yield pa.RecordBatch.from_arrays(
                    [found.column(c) for c in (*ROW, "digest", "lines")], names=[*ROW, "digest", "lines"]
                )


def common_lines(keys: DataFrame, index: DataFrame, limit: int = LIMIT, salts: int = SALTS) -> DataFrame:
    """Lines of each row whose keys are common: row key and sorted line numbers."""
    bits = index.agg(F.coalesce(F.max("bits"), F.lit(0))).first()[0]
    none = F.lit(None)
    filters = index.filter("digest IS NULL").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        "common",
        none.cast("string").alias("row_file"),
        none.cast("bigint").alias("row_index"),
        none.cast("binary").alias("digest"),
        none.cast("array<int>").alias("lines"),
    )
    lines = keys.select(
        shard_of(bits).alias("shard"),
        F.pmod(F.xxhash64(*ROW), F.lit(salts)).cast("int").alias("salt"),
        none.cast("binary").alias("common"),
        *ROW,
        "digest",
        "lines",
    )
    dealt = (
        filters.unionByName(lines)
        .repartition("shard", "salt")
        .sortWithinPartitions("shard", F.col("common").isNull())
    )
    hits = dealt.mapInArrow(_look_up, KEYS)
    sure = index.filter(F.col("refs") >= limit).select("digest")
    return (
        hits.join(sure, "digest")
        .groupBy(*ROW)
        .agg(F.sort_array(F.flatten(F.collect_list("lines"))).alias("dropped"))
    )


@F.pandas_udf(StringType())
def _without(texts: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for text, numbers in zip(texts, dropped, strict=True):
        if text is None:
            out.append(None)
            continue
        gone = set(numbers.tolist())
        out.append("\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone]))
    return pd.Series(out, dtype=object)


def without_common_lines(
    docs: DataFrame, keys: DataFrame, index: DataFrame, limit: int = LIMIT
) -> DataFrame:
    """doc_id, lines of the text, how many were dropped, and the ``kept`` text.

    ``keys`` are those of the same ``docs``.
    """
    source = with_row(docs, F.col("doc_id"), text_of().alias("text"))
    found = settle(common_lines(keys, index, limit), "line-drops")
    # Drops grow with the documents, so they are never broadcast.
    both = source.join(found.hint("merge"), ROW, "left")
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    loses = F.col("dropped").isNotNull()
    return both.select(
        "doc_id",
        (breaks + 1).cast("bigint").alias("n_lines"),
        F.when(loses, F.size("dropped")).otherwise(0).cast("bigint").alias("n_dropped"),
        F.coalesce(_without(F.when(loses, F.col("text")), F.col("dropped")), F.col("text")).alias("kept"),
    )
