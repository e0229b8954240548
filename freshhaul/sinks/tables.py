"""Serving tables kept as Parquet: logs that grow, and snapshots that are replaced."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul import storage
from freshhaul.functions.times import moment
from freshhaul.operators.cleaning import with_partitions
from freshhaul.operators.merge import prune, upsert
from freshhaul.schemas import MODEL_METRICS, PIPELINE_RUNS, TABLE_KEYS, conform
from freshhaul.sources.files import read_zone_or_none

DAY_PARTS = ["year", "month", "day"]
SNAPSHOT_TABLES = {"fleet_status", "registry", "recent_readings"}


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots, ascending. Spark writes _SUCCESS last."""
    numbers = [
        int(n.split("=")[1]) for n in storage.names(spark, path) if n.startswith("snapshot=")
    ]
    return sorted(
        n for n in numbers if storage.exists(spark, f"{path}/snapshot={n}/_SUCCESS")
    )


def read_snapshot(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The latest complete snapshot, or an empty frame of the table's schema."""
    schema, _ = TABLE_KEYS[table]
    numbers = _snapshots(spark, path)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/snapshot={numbers[-1]}")


def write_snapshot(df: DataFrame, path: str, keep: int = 2) -> int:
    """Write the next snapshot beside the current one, then drop all but the last ``keep``.

    Readers see the old snapshot until the new one is complete; a failed write
    leaves no _SUCCESS and is overwritten by the next attempt.
    """
    spark = df.sparkSession
    numbers = _snapshots(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    df.write.mode("overwrite").parquet(f"{path}/snapshot={number}")
    for old in [*numbers, number][:-keep]:
        storage.remove(spark, f"{path}/snapshot={old}")
    return number


def upsert_table(
    spark: SparkSession, path: str, table: str, updates: DataFrame, changed_on: str, now: datetime
) -> int:
    """Merge ``updates`` into the keyed table and publish the result."""
    _, key = TABLE_KEYS[table]
    current = read_snapshot(spark, path, table)
    return write_snapshot(upsert(current, updates, key, changed_on, now), path)


def ensure_table(spark: SparkSession, path: str, table: str) -> None:
    """Create the table unless it exists: an empty snapshot, or an empty log folder."""
    schema, _ = TABLE_KEYS[table]
    if storage.names(spark, path):
        return
    if table in SNAPSHOT_TABLES:
        write_snapshot(spark.createDataFrame([], schema), path)
    else:
        storage.make_folder(spark, path)


def append_rows(df: DataFrame, path: str, time: str | None = None) -> None:
    """Append to a log table; with ``time``, laid out by the day of that column."""
    if time is None:
        df.write.mode("append").parquet(path)
        return
    by_day = with_partitions(df.withColumn("event_time", F.col(time))).select(
        *df.columns, *DAY_PARTS
    )
    by_day.write.mode("append").partitionBy(*DAY_PARTS).parquet(path)


def read_log(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Log table, or an empty frame of its schema when nothing is stored yet."""
    schema, _ = TABLE_KEYS[table]
    df = read_zone_or_none(spark, path)
    return spark.createDataFrame([], schema) if df is None else df


def read_history(spark: SparkSession, path: str, now: datetime, hours: float) -> DataFrame:
    """Sensor history within the retention: the date bound prunes directories, the
    time bound is exact, so expired rows are invisible before they are removed."""
    df = read_log(spark, path, "sensor_history")
    kept = prune(df, now, hours)
    if "year" not in df.columns:
        return kept
    since = (now - timedelta(hours=hours)).date()
    return kept.filter(F.make_date("year", "month", "day") >= F.lit(since)).drop(*DAY_PARTS)


def drop_expired_days(spark: SparkSession, path: str, now: datetime, hours: float) -> list[str]:
    """Remove day partitions that lie wholly before the retention bound (no rewrite)."""
    since = (now - timedelta(hours=hours)).date()

    def parts(path: str) -> list[str]:
        return [n for n in storage.names(spark, path) if "=" in n]

    removed = []
    for year in parts(path):
        for month in parts(f"{path}/{year}"):
            for day in parts(f"{path}/{year}/{month}"):
                y, m, d = (int(n.split("=")[1]) for n in (year, month, day))
                if date(y, m, d) < since:
                    storage.remove(spark, f"{path}/{year}/{month}/{day}")
                    removed.append(f"{year}/{month}/{day}")
    return removed


def drop_expired_rows(spark: SparkSession, path: str, now: datetime, hours: float) -> bool:
    """Rewrite the one day that the retention bound cuts through; whether there was anything to drop.

    Only that day's partition is read and replaced, by dynamic partition overwrite: readers
    see its old files until the new ones are committed. Days before it are left to
    ``drop_expired_days``.
    """
    since = (now - timedelta(hours=hours)).date()
    day = f"{path}/year={since.year}/month={since.month}/day={since.day}"
    if not storage.exists(spark, day):
        return False
    rows = spark.read.option("basePath", path).parquet(day)
    kept = prune(rows, now, hours)
    cutoff = moment(now - timedelta(hours=hours), rows.schema["event_time"].dataType)
    if rows.filter(F.col("event_time") < cutoff).isEmpty():
        return False
    if kept.isEmpty():
        storage.remove(spark, day)
    else:
        replace = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replace.partitionBy(*DAY_PARTS).parquet(path)
    return True


def run_log(
    spark: SparkSession,
    dag_id: str,
    run_id: str,
    status: str,
    rows: int,
    seconds: int,
    run_at: datetime,
) -> DataFrame:
    """One row about a finished run."""
    row = (dag_id, run_id, status, rows, seconds, None)
    return spark.createDataFrame([row], PIPELINE_RUNS).withColumn("run_at", moment(run_at))


def append_metrics(df: DataFrame, path: str) -> None:
    append_rows(conform(df, MODEL_METRICS), path)
