"""Documents to training ids: quality, copies, near copies, mix, encoding.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir), works on all rows
that the one before kept, and returns a frame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``. Null and
empty texts are treated as each operator says; no documents give no rows at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.llm.byte_bpe import Codec
from freshhaul.llm.common import settle, table
from freshhaul.llm.exact_dedup import without_copies
from freshhaul.llm.mixing import mixed
from freshhaul.llm.ngram_join import Rule, one_of_each
from freshhaul.llm.quality_classifier import good_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id."""
    return without_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group linked by five-word shingles at a similarity of 0.8."""
    return one_of_each(docs, Rule(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, one row for each time."""
    return mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether they decode to its text."""
    codec = Codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = docs.withColumn("coded", codec.checked())
    return coded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("coded.ids") / 4).cast("bigint").alias("n_tokens"),
        F.col("coded.ids").alias("ids"),
        F.col("coded.same").alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Neither the classifier nor the merges can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
