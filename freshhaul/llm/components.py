"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul import storage
from freshhaul.session import scratch_path


def _write(edges: DataFrame, path: str) -> DataFrame:
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other, and on none that hangs itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    ties = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ties.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches; only nodes with links.

    ``links`` has columns a and b. Large-star and small-star steps take turns: each round
    hangs the larger neighbours of a node, then the smaller, on the smallest it knows,
    until all that is left are stars. A round is a few joins and aggregations over the
    links, is written out, and needs no memory beyond them; a hub is a skewed join, not one
    group. The table of a round goes when the next one is written.
    """
    spark = links.sparkSession
    path = scratch_path(spark, name)
    downward = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = _write(links.filter("a <> b").select(*downward).distinct(), path)
    while not _are_stars(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("u"), F.least("a", "low").alias("low")
        )
        large = (
            both.join(least, both["a"] == least["u"])
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        down = large.filter("a <> b").select(*downward)
        low = down.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
        small = down.join(low, down["a"] == low["u"]).select("b", "low")
        after = scratch_path(spark, name)
        edges = _write(
            small.filter("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low.select("u", "low"))
            .distinct(),
            after,
        )
        storage.remove(spark, path)
        path = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
