"""Top-n, hold-out, stratified split and seeded sample, all deterministic."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.operators.enrich import settled


def top_n(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def holdout_keys(df: DataFrame, key: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows of the last ``n`` keys in sorted order go to test."""
    last = df.select(key).distinct().orderBy(F.desc(key)).limit(n)
    held = settled(last)  # its size decides whether it is broadcast
    return df.join(held, key, "left_anti"), df.join(held, key, "left_semi")


def _shuffle_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def split_quotas(sizes: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Test rows per class: proportional shares, remainders to the largest fractions.

    ``sizes`` has one row per class (columns label, n).
    """
    everything = Window.partitionBy(F.lit(1))  # one row per class
    total = F.sum("n").over(everything)
    wanted = F.ceil(total * F.lit(test_fraction))
    ideal = wanted * F.col("n") / total
    shares = sizes.select(
        label, "n", wanted.alias("_wanted"), F.floor(ideal).alias("_base"), ideal.alias("_ideal")
    )
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.col("_ideal") - F.col("_base")), label)
    spare = F.col("_wanted") - F.sum("_base").over(everything)
    extra = F.when(F.row_number().over(order) <= spare, 1).otherwise(0)
    return shares.select(label, "n", (F.col("_base") + extra).alias("quota"))


def stratified_split(
    df: DataFrame, label: str, key: str, test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: per class the rows first in hash order are 'test', the rest 'train'.

    Class sizes are exact. Rows are sliced by hash prefix and counted; in the one slice
    per class that the quota cuts through, about 1/65,536 of the class, hashes and keys
    are ordered to find the last row of the quota. Each row is then decided by comparing
    its hash with that one, without moving. ``key`` should be unique (dedupe first);
    rows with a null label are left out.
    """
    hashed = df.filter(F.col(label).isNotNull()).withColumn("_h", _shuffle_key(key, seed)).withColumn(
        "_slice", F.substring("_h", 1, 4)
    )
    slices = hashed.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    sizes = slices.groupBy(label).agg(F.sum("_n").alias("n"))
    quotas = split_quotas(sizes, label, test_fraction)

    running = Window.partitionBy(label).orderBy("_slice")
    upto = F.sum("_n").over(running.rowsBetween(Window.unboundedPreceding, 0))
    reached = F.col("_upto") >= F.col("quota")
    cuts = (
        slices.withColumn("_upto", upto)
        .join(quotas, label)
        .groupBy(label)
        .agg(
            F.min(F.when(reached, F.col("_slice"))).alias("_cut"),
            F.max("quota").alias("_quota"),
            F.coalesce(F.max(F.when(~reached, F.col("_upto"))), F.lit(0)).alias("_below"),
        )
        .select(label, "_cut", (F.col("_quota") - F.col("_below")).alias("_take"))
    )
    # Inside the slice that a quota cuts, only hash and key of the rows are ordered.
    cut = settled(cuts)
    order = Window.partitionBy(label).orderBy("_h", key)
    edges = (
        hashed.select(label, "_h", "_slice", key)
        .join(cut, label)
        .filter(F.col("_slice") == F.col("_cut"))
        .withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") == F.col("_take"))
        .select(label, F.struct("_h", key).alias("_edge"))
    )
    marked = hashed.join(settled(edges), label, "left")
    inside = F.coalesce(F.struct("_h", key) <= F.col("_edge"), F.lit(False))
    return marked.withColumn("split", F.when(inside, "test").otherwise("train")).select(
        *df.columns, "split"
    )


def tasks_for(df: DataFrame, rows: int, least: int = 15_000, most: int = 200_000) -> int:
    """Tasks for work that reads ``rows`` many times: all cores, from ``least`` to ``most`` rows each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(ceil(rows / least), max(cores, ceil(rows / most))))


def spread(df: DataFrame, rows: int, order: list[str] | None = None, least: int = 15_000) -> DataFrame:
    """The rows dealt evenly over ``tasks_for`` them, each task's in ``order`` if given.

    A small file or a shuffle that was made for few bytes leaves all rows in one task, also
    where each row is then worked on for long. Few rows stay where they are.
    """
    tasks = tasks_for(df, rows, least)
    if tasks == 1:
        return df
    dealt = df.repartition(tasks)
    return dealt.sortWithinPartitions(*order) if order else dealt


def seeded_sample(df: DataFrame, n: int, key: str = "event_id", seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the first in hash order (a distributed top-n)."""
    return df.orderBy(_shuffle_key(key, seed), key).limit(n)
