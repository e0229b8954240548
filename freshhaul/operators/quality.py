"""Null profile and statistics learned from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.operators.enrich import settled
from freshhaul.schemas import SENSORS

PROFILED = ["temperature", "humidity", "methane", "co2", "food_name", "truck_id"]


def _null_counts(df: DataFrame) -> list[Column]:
    return [
        (F.count_if(F.col(n).isNull()) if n in df.columns else F.lit(0).cast("long")).alias(n)
        for n in PROFILED
    ]


def quality(df: DataFrame) -> DataFrame:
    """One row per profiled column: nulls, their percentage (null when empty), total.

    A single pass, in place of one job per column.
    """
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), *_null_counts(df))
    pairs = ", ".join(f"'{name}', {name}" for name in PROFILED)
    long = counts.selectExpr(
        "total_rows", f"stack({len(PROFILED)}, {pairs}) AS (column_name, null_count)"
    )
    pct = F.when(
        F.col("total_rows") > 0,
        F.round(F.col("null_count") / F.col("total_rows") * F.lit(100.0), 1),
    )
    return long.select("column_name", "null_count", pct.alias("null_pct"), "total_rows")


def with_null_flags(df: DataFrame) -> DataFrame:
    """Mark what is missing before imputation fills it, for counts in a later aggregate."""
    return df.withColumns(
        {
            f"_no_{n}": F.col(n).isNull() if n in df.columns else F.lit(False)
            for n in PROFILED
        }
    )


def flagged_nulls() -> list[Column]:
    """Counts of the flags, to go along with another aggregate over the same rows."""
    return [F.count_if(f"_no_{n}").alias(f"_no_{n}") for n in PROFILED]


def null_totals(groups: DataFrame) -> DataFrame:
    """One row: the flag counts of all groups summed up."""
    return groups.agg(
        *[F.coalesce(F.sum(f"_no_{n}"), F.lit(0)).alias(n) for n in PROFILED]
    )


def _exponent(value: Column) -> Column:
    """Sign and binary exponent as one number, which rises with the value; NaN comes last."""
    size = F.floor(F.log2(F.abs(value))) + F.lit(1100)
    return (
        F.when(F.isnan(value), F.lit(4000))
        .when(value == 0, F.lit(0))
        .otherwise(F.least(F.lit(3000), F.greatest(F.lit(1), size)) * F.signum(value))
        .cast("int")
    )


def _bin_of_rank(bins: DataFrame, key: str) -> DataFrame:
    """The bin of each key in which its rank lies; a key has a bounded number of bins."""
    order = Window.partitionBy(key).orderBy("_bin")
    upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        bins.withColumn("_upto", F.col("_below") + upto)
        .filter((F.col("_upto") - F.col("_n") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
        .select(key, "_total", "_rank", (F.col("_upto") - F.col("_n")).alias("_below"), "_n", "_low", "_high")
    )


def exact_median(df: DataFrame, key: str, value: str, bound: int = 100_000) -> DataFrame:
    """Exact median of ``value`` per ``key``, for keys of any size and any spread of values.

    Radix selection: a first pass counts rows by sign and exponent, further ones by 4,096
    equal parts of what is left, all with map-side combine, until no more than ``bound``
    rows (or one value) can hold the middle rank of a key. Four passes settle a double's
    52 bits. Only those few are ordered, and one pass finds the value above them where an
    even number of rows needs it. Nulls are left out; NaN is above every number.
    """
    rows = settled(df.filter(F.col(value).isNotNull()).select(key, F.col(value).alias("_v")))
    within = [
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
    ]
    bins = rows.groupBy(key, _exponent(F.col("_v")).alias("_bin")).agg(*within)
    totals = F.sum("_n").over(Window.partitionBy(key))
    state = settled(
        _bin_of_rank(
            bins.withColumn("_total", totals)
            .withColumn("_rank", F.expr("(_total + 1) div 2"))
            .withColumn("_below", F.lit(0).cast("long")),
            key,
        )
    )
    wide = (F.col("_n") > bound) & (F.col("_low") < F.col("_high"))
    while state.filter(wide).limit(1).count():
        part = F.least(
            F.lit(4095), F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * 4096)
        )
        inside = F.col("_v").between(F.col("_low"), F.col("_high"))
        narrowed = (
            rows.join(state.filter(wide).drop("_n"), key)
            .filter(inside)
            .groupBy(key, "_total", "_rank", "_below", part.alias("_bin"))
            .agg(*within)
        )
        state = settled(state.filter(~wide).unionByName(_bin_of_rank(narrowed, key)))

    counted = (
        rows.join(state.drop("_n"), key)
        .filter(F.col("_v") >= F.col("_low"))
        .groupBy(key, "_total", "_rank", "_below", F.when(F.col("_v") <= F.col("_high"), F.col("_v")).alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"))
    )
    order = Window.partitionBy(key).orderBy(F.col("_x").asc_nulls_last())
    placed = counted.withColumn(
        "_upto", F.col("_below") + F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    picks = [
        F.max(F.when((F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto")), F.col("_least")))
        for rank in (F.col("_rank"), F.expr("_total div 2 + 1"))
    ]
    return (
        placed.groupBy(key)
        .agg(picks[0].alias("_a"), picks[1].alias("_z"), F.max("_total").alias("n"))
        .select(key, (F.col("_a") * 0.5 + F.col("_z") * 0.5).alias("median"), "n")
    )


def learn_profile(df: DataFrame) -> DataFrame:
    """Median temperature per food, from which imputation constants can be renewed."""
    known = df.filter(F.col("food_name").isNotNull())
    return exact_median(known, "food_name", "temperature").select(
        "food_name", F.col("median").alias("temperature_median"), "n"
    )


def learn_global(df: DataFrame) -> DataFrame:
    """Per reading: count, min, max, mean, sample deviation and exact median."""
    pairs = ", ".join(f"'{name}', {name}" for name in SENSORS)
    long = df.selectExpr(f"stack({len(SENSORS)}, {pairs}) AS (reading, value)").filter(
        F.col("value").isNotNull()
    )
    stats = long.groupBy("reading").agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
    )
    return stats.join(exact_median(long, "reading", "value"), "reading")
