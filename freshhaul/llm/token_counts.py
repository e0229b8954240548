"""Token counts: an exact histogram of encoded lengths and what follows from it.

Documents are counted by their length in tokens; map tasks add up their own counts first.
With the suffix sums of the histogram - documents and tokens at each length and above -
every question about a context limit is one row: how many documents are longer, how many
tokens fit when longer ones are truncated, which length a quantile has.

Sums run in two steps, over bins of lengths and inside each bin, so no task needs the
whole histogram. Null and empty texts have length 0 and count as documents. No documents:
an empty histogram.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshhaul.llm.common import settle, text_of

#: Lengths of a bin; a task sums one bin at a time.
BIN = 4096


def token_counter(spark: SparkSession, path: str, pattern: str) -> Column:
    """Column with the number of tokens of ``text`` under the ranks in ``path``."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    ranks = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in lines})

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for batch in batches:
            yield pd.Series([len(codec.encode_ordinary(t)) for t in batch], dtype="int64")

    return count(text_of())


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents of each length: n_tokens, n_docs."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame, width: int = BIN) -> DataFrame:
    """Each length with the documents and tokens at that length or above, and the totals."""
    binned = histogram.withColumn("bin", F.floor(F.col("n_tokens") / width)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    later = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bins = binned.groupBy("bin").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = bins.select(
        "bin",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    here = (
        Window.partitionBy("bin")
        .orderBy(F.col("n_tokens").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return binned.join(above, "bin").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(here) + F.col("docs_later")).alias("docs_from"),
        (F.sum("tokens").over(here) + F.col("tokens_later")).alias("tokens_from"),
        "all_docs",
        "all_tokens",
    )


def context_limits(sums: DataFrame) -> DataFrame:
    """What a context limit of each length that occurs would keep and cut.

    ``kept_tokens`` is the total with longer documents cut at the limit; ``whole_docs``
    fit whole; ``quantile`` is the share of documents that are no longer.
    """
    longer = F.col("docs_from") - F.col("n_docs")
    tokens_longer = F.col("tokens_from") - F.col("n_tokens") * F.col("n_docs")
    kept = F.col("all_tokens") - tokens_longer + longer * F.col("n_tokens")
    return sums.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("all_docs") - longer).alias("whole_docs"),
        kept.alias("kept_tokens"),
        (F.col("all_tokens") - kept).alias("cut_tokens"),
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens kept under each of a few limits, which need not occur as lengths."""
    known = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    cut = F.when(F.col("n_tokens") > F.col("context_limit"), F.col("context_limit")).otherwise(
        F.col("n_tokens")
    )
    rows = sums.select("n_tokens", "n_docs").withColumn(
        "context_limit", F.explode(F.array(*[F.lit(int(x)) for x in limits]).cast("array<bigint>"))
    )
    totals = rows.groupBy("context_limit").agg(F.sum(cut * F.col("n_docs")).alias("kept_tokens"))
    return known.join(totals, "context_limit", "left").fillna(0, ["kept_tokens"])


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of the documents does not exceed."""
    upto = F.col("all_docs") - F.col("docs_from") + F.col("n_docs")
    rows = sums.select("n_tokens", "all_docs", upto.alias("upto")).withColumn(
        "share", F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    )
    reached = rows.filter(F.col("upto") >= F.col("share") * F.col("all_docs"))
    return reached.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Context limits over the token lengths of all documents."""
    counts = docs.select(token_counter(docs.sparkSession, path, pattern).alias("n_tokens"))
    return context_limits(suffix_sums(settle(length_histogram(counts), "token-histogram")))
