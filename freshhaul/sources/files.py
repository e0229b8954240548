"""Parquet zones and CSV readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshhaul import storage
from freshhaul.operators.cleaning import with_event_time, with_partitions
from freshhaul.schemas import CSV_RENAMES, SENSOR_CSV


def read_zone(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Partitioned Parquet zone. A schema spares the footer reads of inference."""
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_zone_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The zone, or None when it does not exist yet or holds no file."""
    found = [n for n in storage.names(spark, path) if not n.startswith(("_", "."))]
    return read_zone(spark, path, schema) if found else None


def read_readings_csv(
    spark: SparkSession, path: str, stamp_now: bool = False, schema: T.StructType = SENSOR_CSV
) -> DataFrame:
    """Readings with canonical names, event time and its parts.

    ``stamp_now`` takes the current time as event time, as a demo run does.
    """
    df = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .csv(path)
        .withColumnsRenamed(CSV_RENAMES)
    )
    timed = (
        df.withColumn("event_time", F.current_timestamp()) if stamp_now else with_event_time(df)
    )
    return with_partitions(timed)


def or_else(df: DataFrame | None, fallback: DataFrame) -> DataFrame:
    """``df`` unless it is absent or empty (stops at the first row)."""
    return fallback if df is None or df.isEmpty() else df
