"""Trie of conversation prefixes, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns (role and text); the root has none. Sequences
are told apart by 128 bits: the exclusive-or of hashes of place and turn, which a running
window yields for every prefix. Node and parent are named by the smallest conversation
that starts with them and their depth.

What a node holds together with all below it (childless nodes, words that a shared prefix
saves) comes from contracting the tree in rounds of joins. A round rakes all leaves, whose
totals are final, into their parents; then it compresses chains: a node with one child is
spliced out if its coin shows heads and its parent's shows tails, so that no two neighbours
go at once, and its child remembers what lies between it and its new parent. Each round
takes away a fixed share of the nodes, also of a chain as long as the table, so there are
logarithmically many. At last the spliced nodes are expanded, latest round first, from the
total of the child that they left behind. Rounds are tables in the shared folder, together
a few times as large as the first.

Null roles and texts count as empty. Turns are ordered by number, null first; those alike in
number by role and a digest of the text. Rows without ``conv_id`` belong to no conversation.
Conversations alike, or one with most of all turns, are no special case: counts are
combined before they are shuffled, and running windows restart every ``CHUNK`` turns from
sums of what came before. Other columns are not read. No conversations: no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.llm.common import WORD, settle

#: Turn numbers, or turns, that one window runs over.
CHUNK = 4096
NODE = ["conv_id", "depth"]
FIRST = -(2**62)  # sorts before every part that turns with a number fall into


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place from 1, 120 bits of a digest of role and text (a, b), words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role), F.lit(":"), role, text).cast("binary"), 256)
    bits = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("bigint")
    rows = (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            role.alias("role"),
            digest.alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        )
        .withColumn("part", F.coalesce(F.expr(f"turn div {CHUNK}"), F.lit(FIRST)))
    )
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "part").orderBy(
        F.col("turn").asc_nulls_first(), "role", "digest"
    )
    return (
        rows.join(before, ["conv_id", "part"])
        .withColumn("place", F.col("before") + F.row_number().over(inside))
        .select("conv_id", "place", bits(1).alias("a"), bits(16).alias("b"), "words")
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """Keys (a, b) of the prefix that ends with each turn and of the one before it."""
    tagged = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        "words",
        F.expr(f"(place - 1) div {CHUNK}").alias("part"),
        F.xxhash64(F.lit(1), "a", "b", "place").alias("x"),
        F.xxhash64(F.lit(2), "b", "place", "a").alias("y"),
    )
    both = lambda w: (F.bit_xor("x").over(w).alias("x"), F.bit_xor("y").over(w).alias("y"))
    past = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        tagged.groupBy("conv_id", "part")
        .agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        .select("conv_id", (F.col("part") + 1).alias("part"), *both(past))
        .select("conv_id", "part", F.col("x").alias("x0"), F.col("y").alias("y0"))
    )
    order = Window.partitionBy("conv_id", "part").orderBy("depth")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    none = F.lit(0).cast("bigint")
    own = tagged.withColumns(
        {"kx": F.bit_xor("x").over(upto), "ky": F.bit_xor("y").over(upto)}
    ).join(sums, ["conv_id", "part"], "left")
    key = lambda k, at: F.col(k).bitwiseXOR(F.coalesce(at, none))
    return own.select(
        "conv_id", "depth", "words", "x", "y",
        key("kx", F.col("x0")).alias("a"), key("ky", F.col("y0")).alias("b"),
    ).select(
        "conv_id", "depth", "words", "a", "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
    )


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each group of rows alike in depth and key, which come in order."""
    names = ["depth", "a", "b", "ends_sha256"]
    kinds = [pa.int64()] * 3 + [pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    now, digest = None, None
    for batch in batches:
        rows = []
        for *key, conv_id in zip(
            *[batch.column(c).to_pylist() for c in ("depth", "a", "b", "conv_id")], strict=True
        ):
            if key != now:
                if now is not None:
                    rows.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(b"," + str(conv_id).encode())
        yield made(rows)
    if now is not None:
        yield made([(*now, digest.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node (depth, a, b): decimal, ascending, with commas."""
    key = ["depth", "a", "b"]
    ordered = ends.select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id")
    return ordered.mapInArrow(_ends, "depth bigint, a bigint, b bigint, ends_sha256 string")


def coin(conv_id: str, depth: str, turn: int) -> Column:
    """Heads or tails for a node in a round."""
    return F.xxhash64(F.lit(turn), conv_id, depth).bitwiseAND(F.lit(1)) == 1


def contracted(nodes: DataFrame) -> DataFrame:
    """Totals of ``leaves`` and ``saved`` over the subtree of each node.

    ``nodes``: conv_id, depth, parent_conv_id, parent_depth (null for the root, the only
    node without parent), n_children, and the node's own leaves and saved.
    """
    none = F.lit(0).cast("bigint")
    parent = ["parent_conv_id", "parent_depth"]
    values = ["leaves", "saved"]
    live = settle(
        nodes.select(
            *NODE, *parent, F.col("n_children").alias("k"), *values,
            none.alias("up_leaves"), none.alias("up_saved"),
            *[F.lit(None).cast("bigint").alias(f"old_{c}") for c in (*NODE, *values)],
        ),
        "trie-live",
    )
    rounds = [live]
    below_root = F.col("parent_depth").isNotNull()
    while live.filter(below_root).limit(1).count():
        turn = len(rounds)
        # Rake: leaves give their totals to their parents.
        gain = (
            live.filter(below_root & (F.col("k") == 0))
            .groupBy(*[F.col(p).alias(c) for p, c in zip(parent, NODE, strict=True)])
            .agg(
                F.count("*").alias("raked"),
                *[F.sum(F.col(v) + F.col(f"up_{v}")).alias(f"more_{v}") for v in values],
            )
        )
        raked = settle(
            live.filter(~below_root | (F.col("k") > 0))
            .join(gain, NODE, "left")
            .select(
                *NODE, *parent,
                (F.col("k") - F.coalesce("raked", none)).alias("k"),
                *[(F.col(v) + F.coalesce(f"more_{v}", none)).alias(v) for v in values],
                *[f"up_{v}" for v in values],
            ),
            "trie-raked",
        )
        # Compress: splice out nodes with one child; heads below tails, the root is tails.
        heads = coin(*NODE, turn)
        tails = (F.col("parent_depth") == 0) | ~coin(*parent, turn)
        spliced = F.coalesce(below_root & (F.col("k") == 1) & heads & tails, F.lit(False))
        out = raked.filter(spliced).select(
            *[F.col(c).alias(f"old_{c}") for c in NODE],
            *[F.col(p).alias(f"grand_{p}") for p in parent],
            *[F.col(v).alias(f"old_{v}") for v in values],
            *[F.col(f"up_{v}").alias(f"old_up_{v}") for v in values],
        )
        gone = F.col("old_depth").isNotNull()
        live = settle(
            raked.filter(~spliced)
            .join(
                out,
                [F.col(p) == F.col(f"old_{c}") for p, c in zip(parent, NODE, strict=True)],
                "left",
            )
            .select(
                *NODE,
                *[F.when(gone, F.col(f"grand_{p}")).otherwise(F.col(p)).alias(p) for p in parent],
                "k",
                *values,
                *[
                    F.when(gone, F.col(f"up_{v}") + F.col(f"old_{v}") + F.col(f"old_up_{v}"))
                    .otherwise(F.col(f"up_{v}"))
                    .alias(f"up_{v}")
                    for v in values
                ],
                *[f"old_{c}" for c in NODE],
                # What the spliced node has besides its child's total.
                *[(F.col(f"old_{v}") + F.col(f"up_{v}")).alias(f"old_{v}") for v in values],
            ),
            "trie-live",
        )
        rounds.append(live)

    # What was left or raked is final; spliced nodes are expanded from their child's total.
    totals = [rounds[-1].select(*NODE, *values)]
    for before, after in zip(rounds[-2::-1], rounds[:0:-1], strict=True):
        child = reduce(DataFrame.unionByName, totals)
        found = (
            after.filter("old_depth IS NOT NULL")
            .select(*NODE, *[f"old_{c}" for c in (*NODE, *values)])
            .join(child, NODE)
            .select(
                *[F.col(f"old_{c}").alias(c) for c in NODE],
                *[(F.col(f"old_{v}") + F.col(v)).alias(v) for v in values],
            )
        )
        totals.append(settle(found, "trie-totals"))
        totals.append(before.filter(below_root & (F.col("k") == 0)).select(*NODE, *values))
    return reduce(DataFrame.unionByName, totals)


def prefix_trie(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie, and where each conversation ends.

    ``turns``: conv_id, place from 1 without gaps, a, b and words, as from ``turn_rows``.
    ``members``: every ``conv_id`` once, those without turns included. Nodes have conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and a key (depth, a,
    b); the second frame has conv_id and the key of the node at which it ends.
    """
    zero = F.lit(0).cast("bigint")
    members = settle(members.select("conv_id"), "trie-members")
    prefixes = settle(_prefixes(turns), "trie-prefixes")
    count, least = members.agg(F.count("*"), F.min("conv_id")).first()

    inner = prefixes.groupBy("depth", "a", "b").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
    )
    inner = settle(inner, "trie-nodes")
    above = inner.select(
        F.col("conv_id").alias("parent_conv_id"),
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
    )
    columns = ["conv_id", "depth", "a", "b", "parent_conv_id", "parent_depth", "n_convs", "words"]
    parent_depth = (F.col("depth") - 1).alias("parent_depth")
    first = inner.filter("depth = 1").withColumn("parent_conv_id", F.lit(least).cast("bigint"))
    deeper = inner.filter("depth > 1").join(above, ["depth", "pa", "pb"])
    root = members.limit(1).select(
        F.lit(least).cast("bigint").alias("conv_id"), zero.alias("depth"), zero.alias("a"), zero.alias("b"),
        F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(None).cast("bigint").alias("parent_depth"),
        F.lit(count).cast("bigint").alias("n_convs"), zero.alias("words"),
    )
    below = (
        first.withColumn("parent_depth", parent_depth)
        .select(*columns)
        .union(deeper.withColumn("parent_depth", parent_depth).select(*columns))
    )
    named = settle(root.select(*columns).union(below), "trie-named")
    children = named.groupBy(
        F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = settle(
        named.join(children, NODE, "left")
        .withColumn("n_children", F.coalesce("n_children", zero))
        .withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")),
        "trie-weighed",
    )
    totals = contracted(nodes).select(
        *NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")
    )
    trie = nodes.join(totals, NODE).select(
        *NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "a", "b"
    )
    lengths = prefixes.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b")).alias("end"))
    ends = members.join(lengths, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"end.{c}", zero).alias(c) for c in ("depth", "a", "b")]
    )
    return trie, ends
