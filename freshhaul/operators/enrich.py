"""Dimension lookups and joins with aggregates of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.reference import UNKNOWN_FOOD, food_ref
from freshhaul.session import scratch_path


def lookup(df: DataFrame, dim: DataFrame, key: str, defaults: dict[str, float | str]) -> DataFrame:
    """Left join of ``dim`` on ``key``; a missing key takes the default of each column.

    No hint is set: Catalyst broadcasts a dimension whose size it knows to be
    small and uses a skew-aware sort-merge join beyond that.
    """
    joined = df.join(dim.select(key, *defaults), key, "left")
    return joined.select(
        *df.columns,
        *[F.coalesce(F.col(name), F.lit(value)).alias(name) for name, value in defaults.items()],
    )


def with_food_ref(df: DataFrame, *columns: str, dim: DataFrame | None = None) -> DataFrame:
    """Add the named food reference columns that the frame does not carry yet.

    A plan that uses several of them attaches all at once, so the chain of
    operators after it shares a single broadcast join.
    """
    wanted = {name: UNKNOWN_FOOD[name] for name in columns if name not in df.columns}
    if not wanted:
        return df
    return lookup(df, food_ref(df.sparkSession) if dim is None else dim, "food_name", wanted)


def settled(df: DataFrame) -> DataFrame:
    """The frame as a small table in the shared folder.

    For aggregates that a large input is joined with. Their size cannot be
    estimated, so Catalyst would shuffle the large side. The files of a written
    table give the exact size: below ``spark.sql.autoBroadcastJoinThreshold`` it
    is broadcast, beyond that the join is a skew-aware sort-merge join. It also
    cuts the lineage, so a lost executor does not repeat the aggregation.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
