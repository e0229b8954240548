"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.llm.byte_bpe import encode_documents
from freshhaul.llm.common import settle, table
from freshhaul.llm.conversation_repair import repair_edits
from freshhaul.llm.conversation_trie import ends_digests, prefix_trie, turn_rows
from freshhaul.llm.exact_dedup import exact_groups
from freshhaul.llm.html_extract import extracted
from freshhaul.llm.line_dedup import insert, line_keys, without_common_lines
from freshhaul.llm.mixing import mix
from freshhaul.llm.ngram_join import Rule, ngram_components
from freshhaul.llm.quality_classifier import quality_scores
from freshhaul.llm.repetition import repetition_rules
from freshhaul.llm.sql import CONVERSATION_TRIE, EXACT_DEDUP, LINE_DEDUP, MIX, REPETITION
from freshhaul.llm.substring_dedup import without_repeats
from freshhaul.llm.token_counts import token_counts
from freshhaul.llm.url_filter import rules, url_verdicts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), Rule(words=4, percent=85)).select(
        "doc_id", "n_shingles", "component_id"
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", extracted().alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


URL_RULES = rules(
    [
        "allow com/",
        "block example.com/en/",
        "allow www.example.com/en/",
        "block net/es/",
        "block net/fr/",
    ]
)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_verdicts(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = lambda s: s["stop"] - s["start"]
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate(
            F.transform("spans", length), F.lit(0).cast("bigint"), lambda a, b: a + b
        ).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults of six kinds in a quarter of their turns, by the turn's CRC."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return (
        conversations.select("conv_id", "turn", "role", "text", kind.alias("kind"))
        .filter("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(F.col("kind") == 1, "")
            .when(F.col("kind") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat("kind", F.when(F.col("kind") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )


_REPAIR = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, with the digest of its repaired turns in their order."""
    now, digest, rows = None, None, []
    names = ["conv_id", *_REPAIR, "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    for batch in batches:
        column = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        for i, seq in enumerate(column["seq"]):
            if seq == 0:
                if now is not None:
                    rows.append((*now, digest.hexdigest()))
                now = tuple(column[n][i] for n in names[:-1])
                digest, first = hashlib.sha256(), True
            elif column["edit"][i] != "D":
                line = f"{column['role'][i]}:{column['text'][i]}"
                digest.update((line if first else "\n" + line).encode())
                first = False
        yield batch_of(rows)
        rows = []
    if now is not None:
        yield batch_of([(*now, digest.hexdigest())])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    schema = ", ".join(f"{n} bigint" for n in ["conv_id", *_REPAIR]) + ", audit string, repaired_sha256 string"
    found = repair_edits(damaged(conversations)).mapInArrow(_digested, schema)
    every = conversations.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in _REPAIR],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keys = settle(line_keys(docs), "line-keys")
    return without_common_lines(docs, keys, insert(None, keys)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and all conversations: they share first turns.

    Up to three first turns of every twentieth conversation also begin those that follow it,
    which lose as many of their own.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = settle(
        convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), h.alias("h")),
        "trie-convs",
    )
    bases = convs.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    drawn = convs.join(bases, "base", "left").withColumn(
        "drawn", F.least("h", F.coalesce("base_n", F.lit(0).cast("bigint")))
    )
    heads = turns.filter("place <= 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    first = drawn.join(heads, "base").filter("place <= drawn")
    own = turns.join(drawn, "conv_id").filter("place > h").withColumn(
        "place", F.col("drawn") + F.col("place") - F.col("h")
    )
    columns = ["conv_id", "place", "a", "b", "words"]
    return first.select(*columns).union(own.select(*columns)), convs.select("conv_id")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = settle(turn_rows(table(spark, sf_dir, "conversations")), "trie-turns")
    trie, ends = prefix_trie(*rebuilt(turns))
    return trie.join(ends_digests(ends), ["depth", "a", "b"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_ngram_join": op3_ngram_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mix_sources": op6_mix_sources,
    "op7_repetition_rules": op7_repetition_rules,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op6_mix_sources": MIX,
    "op7_repetition_rules": REPETITION,
    "op8_exact_dedup": EXACT_DEDUP,
    "op12_line_dedup": LINE_DEDUP,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
