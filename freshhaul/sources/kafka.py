"""Message source: Kafka, and decoding of its envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshhaul.schemas import ENVELOPE, SENSOR_EVENT


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    **extra: str,
) -> dict[str, str]:
    """Reader options. A batch takes all that has come unless ``max_per_trigger`` is given.

    Messages that expired before they were read end the stream unless
    ``fail_on_data_loss`` is false, which skips them.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return {**options, **extra}


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def read_envelope_files(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Stream of files that hold the same envelope columns as the Kafka source."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def _decoded(df: DataFrame, body: str, names: dict[str, str]) -> DataFrame:
    kept = [F.col(old).alias(new) for old, new in names.items()]
    return df.select(F.col("value").cast("string").alias(body), *kept)


def decode_envelope(df: DataFrame) -> DataFrame:
    """Message text, arrival time and position in the topic."""
    names = {c: f"kafka_{c}" for c in ("timestamp", "partition", "offset")}
    return _decoded(df, "json_str", names)


def raw_rows(df: DataFrame) -> DataFrame:
    """The landing rows, before any cleaning."""
    names = {"timestamp": "kafka_timestamp", "partition": "partition", "offset": "offset"}
    return _decoded(df, "raw_json", names)


def envelope_of_raw(df: DataFrame) -> DataFrame:
    """Landed raw rows as decoded messages, to run the stream's logic on them again."""
    return df.select(
        F.col("raw_json").alias("json_str"),
        "kafka_timestamp",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def parse_readings(df: DataFrame, schema: T.StructType = SENSOR_EVENT) -> DataFrame:
    """Payload fields as columns; text that is not JSON gives a row of nulls.

    The fields come out of a generator, which filters on them cannot pass. With
    a plain ``data.*`` the optimizer copies ``from_json`` into every predicate,
    and a message is parsed once per copy.
    """
    return df.select(
        F.inline_outer(F.array(F.from_json("json_str", schema))),
        "kafka_timestamp",
        "kafka_partition",
        "kafka_offset",
    )
