"""The streaming pipeline: raw, processed and alert zones from one message source."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from freshhaul.operators.alerts import alerts
from freshhaul.operators.recent import merge_recent
from freshhaul.plans.readings import process_messages
from freshhaul.reference import TRIGGER, WATERMARK
from freshhaul.schemas import PROCESSED
from freshhaul.sinks.tables import read_snapshot, write_snapshot
from freshhaul.sources.kafka import raw_rows

DAYS = ["year", "month", "day"]
EVERY = {"processingTime": TRIGGER}
CONSOLE_COLUMNS = [
    "truck_id", "food_name", "temperature", "methane", "storage_risk_score", "risk_level",
    "temp_breach_flag", "event_time",
]


def start_sink(
    df: DataFrame, name: str, path: str, ckpt: str, partition_by: list[str], trigger: dict
) -> StreamingQuery:
    """Append-only Parquet sink; its checkpoint and file log give exactly-once output."""
    return (
        df.writeStream.queryName(name)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", ckpt)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_raw(df: DataFrame, path: str, ckpt: str, trigger: dict = EVERY) -> StreamingQuery:
    return start_sink(raw_rows(df), "raw", path, ckpt, ["partition"], trigger)


def start_processed(df: DataFrame, path: str, ckpt: str, trigger: dict = EVERY) -> StreamingQuery:
    return start_sink(df, "processed", path, ckpt, DAYS, trigger)


def start_alerts(df: DataFrame, path: str, ckpt: str, trigger: dict = EVERY) -> StreamingQuery:
    return start_sink(alerts(df), "alerts", path, ckpt, DAYS, trigger)


def start_recent(df: DataFrame, path: str, ckpt: str, trigger: dict = EVERY) -> StreamingQuery:
    """Keep the table of each truck's last readings; a batch that is run again is harmless."""
    spark = df.sparkSession

    def merge(batch: DataFrame, _: int) -> None:
        stored = read_snapshot(spark, path, "recent_readings")
        write_snapshot(merge_recent(stored, batch), path)

    return (
        df.writeStream.queryName("recent")
        .foreachBatch(merge)
        .option("checkpointLocation", ckpt)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def start_console(df: DataFrame, rows: int = 5, trigger: dict = EVERY) -> StreamingQuery:
    return (
        df.select(*CONSOLE_COLUMNS)
        .writeStream.queryName("console")
        .format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def processed_stream(spark: SparkSession, path: str) -> DataFrame:
    """The processed zone as a stream of its new files."""
    return spark.readStream.schema(PROCESSED).parquet(path)


def stream_pipeline(
    source: DataFrame,
    paths: dict[str, str],
    watermark: str = WATERMARK,
    trigger: dict = EVERY,
    model: PipelineModel | None = None,
    console: bool = False,
    chain_alerts: bool = True,
) -> dict[str, StreamingQuery]:
    """Start the zone writers. ``paths``: raw, processed, alerts, checkpoints; with recent,
    also the table of each truck's last readings, which follows what alerts follow.

    The alert query follows the processed zone: no second parse, score and dedupe
    state, one trigger later. Without ``chain_alerts`` it reads the source by itself. ``spark.sql.shuffle.partitions`` is fixed for the life of a
    checkpoint with dedupe state; size it for the cluster before the first start.
    """
    marks = paths["checkpoints"]
    rows = process_messages(source, watermark=watermark, model=model)
    queries = {
        "raw": start_raw(source, paths["raw"], f"{marks}/raw", trigger),
        "processed": start_processed(rows, paths["processed"], f"{marks}/processed", trigger),
    }
    follow = rows
    if chain_alerts:
        if trigger.get("availableNow"):
            queries["processed"].awaitTermination()
        follow = processed_stream(source.sparkSession, paths["processed"])
    queries["alerts"] = start_alerts(follow, paths["alerts"], f"{marks}/alerts", trigger)
    if "recent" in paths:
        queries["recent"] = start_recent(follow, paths["recent"], f"{marks}/recent", trigger)
    if console:
        queries["console"] = start_console(rows, trigger=trigger)
    return queries


def await_any(spark: SparkSession, queries: dict[str, StreamingQuery], every: int = 10) -> None:
    """Wait until one of the queries ends, stop the others, and raise its error if it failed."""
    try:
        while all(query.isActive for query in queries.values()):
            spark.streams.resetTerminated()  # forget queries of earlier runs
            spark.streams.awaitAnyTermination(every)
    finally:
        for query in queries.values():
            if query.isActive:
                query.stop()
    for query in queries.values():
        if query.exception() is not None:
            raise query.exception()
