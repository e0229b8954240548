"""Feature table, reports and message encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.operators.rollup import label_summary
from freshhaul.schemas import FEATURES, PARTITIONS, conform


def write_features(df: DataFrame, path: str) -> None:
    """Replace only the hour partitions present in ``df``.

    Rows are rebalanced by hour first, so tasks do not each open a file in every
    partition; AQE splits an hour that is too large and merges small ones.
    """
    (
        conform(df, FEATURES)
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def write_report(df: DataFrame, path: str) -> None:
    """A small aggregate as a single CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def verify_features(spark: SparkSession, path: str) -> DataFrame:
    """Summary of the written table, read back."""
    return label_summary(spark.read.option("basePath", path).parquet(path))


MESSAGE_FIELDS = [
    "event_id", "truck_id", "timestamp", "gps_lat", "gps_lon", "food_name", "temperature",
    "humidity", "methane", "co2", "storage_days", "temp_humidity_index", "gas_spoilage_score",
    "methane_co2_ratio", "temp_deviation", "storage_risk_score", "spoiled", "source",
]


def message_json(df: DataFrame) -> Column:
    """JSON message of a reading; fields the frame lacks are left out."""
    fields = [F.col(name).alias(name) for name in MESSAGE_FIELDS if name in df.columns]
    if "timestamp" not in df.columns:
        fields.append(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    return F.to_json(F.struct(*fields))


def to_messages(df: DataFrame) -> DataFrame:
    return df.select(message_json(df).alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    (
        df.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", topic)
        .save()
    )
