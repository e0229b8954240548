"""Row validity, imputation, clipping, dedupe and derived columns of single readings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshhaul.functions.times import moment
from freshhaul.operators.enrich import with_food_ref
from freshhaul.reference import DEFAULT_FOOD, FILLS, RANGES, UNKNOWN_FOOD

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def with_event_time(df: DataFrame, text: str = "timestamp") -> DataFrame:
    """Parse the text time; unreadable text gives null (also in ANSI mode)."""
    return df.withColumn("event_time", F.try_to_timestamp(F.col(text), F.lit(TIME_FORMAT)))


def valid_rows(df: DataFrame) -> DataFrame:
    """Keep rows with truck, food, time and at least one of temperature, methane, CO2."""
    some_reading = (
        F.col("temperature").isNotNull() | F.col("methane").isNotNull() | F.col("co2").isNotNull()
    )
    return df.filter(
        F.col("truck_id").isNotNull()
        & F.col("food_name").isNotNull()
        & F.col("event_time").isNotNull()
        & some_reading
    )


def default_food(df: DataFrame) -> DataFrame:
    return df.withColumn("food_name", F.coalesce("food_name", F.lit(DEFAULT_FOOD)))


def dedupe(df: DataFrame) -> DataFrame:
    """One row per (event_id, event_time); stateful in a stream, bounded by its watermark.

    A batch keeps the copy that comes first in the topic, by all columns where the
    position is not known; a stream keeps the one that arrives first.
    """
    key = ["event_id", "event_time"]
    if df.isStreaming:
        return df.dropDuplicates(key)
    known = [c for c in ("kafka_partition", "kafka_offset") if c in df.columns]
    order = known or [c for c in df.columns if c not in key]
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def impute(df: DataFrame, profile: str, dim: DataFrame | None = None) -> DataFrame:
    """Fill missing readings: temperature by food, the others by the profile's constants."""
    median = f"{profile}_median_c"
    keep = [name for name in df.columns]
    joined = with_food_ref(df, median, dim=dim)
    filled = {"temperature": F.coalesce("temperature", median, F.lit(UNKNOWN_FOOD[median]))}
    for name, value in FILLS[profile].items():
        filled[name] = F.coalesce(name, F.lit(value))
    return joined.withColumns(filled).select(*keep)


def clip_ranges(df: DataFrame) -> DataFrame:
    """Clamp each reading to its physical range; nulls must be filled before."""
    return df.withColumns(
        {
            name: F.greatest(F.lit(low), F.least(F.lit(high), F.col(name)))
            for name, (low, high) in RANGES.items()
        }
    )


def with_ingest_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.current_timestamp())


def ensure_column(df: DataFrame, name: str, default: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def with_partitions(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Add year, month, day, hour from event time, else arrival time, else ``now``."""
    times = [F.col(n) for n in ("event_time", "kafka_timestamp") if n in df.columns]
    at = F.coalesce(*times, F.current_timestamp() if now is None else now)
    return df.withColumns(
        {
            "year": F.coalesce(F.year(at), F.lit(2026)),
            "month": F.coalesce(F.month(at), F.lit(1)),
            "day": F.coalesce(F.dayofmonth(at), F.lit(1)),
            "hour": F.coalesce(F.hour(at), F.lit(0)),
        }
    )


def lookback(df: DataFrame, now: datetime, hours: float, mode: str = "event_time") -> DataFrame:
    """Rows of the last ``hours``.

    ``event_time``    exact bound, plus a date bound on the partition columns so that
                      directories are pruned (the default, and the correct one);
    ``partition_ge``  year, month and day each compared on its own, which loses the
                      days after a month end;
    ``partition_eq``  same year and month, day from the cutoff on.
    """
    cutoff = now - timedelta(hours=hours)
    year, month, day = F.col("year"), F.col("month"), F.col("day")
    if mode == "partition_ge":
        return df.filter(
            (year >= cutoff.year) & (month >= cutoff.month) & (day >= cutoff.day)
        )
    if mode == "partition_eq":
        return df.filter(
            (year == cutoff.year) & (month == cutoff.month) & (day >= cutoff.day)
        )
    if mode != "event_time":
        raise ValueError(f"unknown look-back mode: {mode}")
    return df.filter(
        (F.make_date(year, month, day) >= F.lit(cutoff.date()))
        & (F.col("event_time") >= moment(cutoff, df.schema["event_time"].dataType))
    )
