"""All zones from one read of the source: a micro-batch is parsed and de-duplicated once.

Each zone has one folder per micro-batch, ``batch=N``, which a repeated batch replaces, so
output is exactly-once without a sink's log. The raw folder is written from the source,
the processed folder from the raw one, and the alerts from the processed one.

What a stream keeps as state lies in the zone itself: ids of earlier batches that the
watermark has not passed. A small table beside the checkpoint, rewritten with each batch,
names these batches and their latest event times. The watermark follows the readings kept
by earlier batches. Zones belong to one checkpoint: a new one starts at batch 0 again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freshhaul import storage
from freshhaul.operators.alerts import alerts
from freshhaul.plans.readings import reprocess
from freshhaul.reference import TRIGGER, WATERMARK
from freshhaul.schemas import PROCESSED
from freshhaul.sources.kafka import raw_rows

DAYS = ["year", "month", "day"]
KEY = ["event_id", "event_time"]
#: Batches with readings above the watermark; times in microseconds.
MARKS = "batch bigint, latest bigint"


def _store(df: DataFrame, zone: str, number: int, partition_by: list[str]) -> DataFrame:
    path = f"{zone}/batch={number}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_batches(
    spark: SparkSession, zone: str, schema: T.StructType, batches: list[int] | None = None
) -> DataFrame:
    """Rows of the zone, or of some of its batches, with the number of their batch."""
    found = {f"batch={n}" for n in batches} if batches is not None else None
    names = [n for n in storage.names(spark, zone) if n.startswith("batch=")]
    paths = [f"{zone}/{n}" for n in names if found is None or n in found]
    typed = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not paths:
        return spark.createDataFrame([], typed)
    return spark.read.schema(typed).option("basePath", zone).parquet(*paths)


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")).first()[0]


def _marks(spark: SparkSession, path: str, number: int) -> list[tuple[int, int]]:
    """Live batches before ``number``: as many as the watermark's delay has triggers."""
    before = f"{path}/batch={number - 1}"
    if not storage.exists(spark, before):
        return []
    return [tuple(row) for row in spark.read.schema(MARKS).parquet(before).collect()]


def batch_writer(
    paths: dict[str, str],
    delay: int,
    model: PipelineModel | None = None,
    written: Callable[[int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``. ``written`` is called when all zones have the batch."""
    notes = f"{paths['checkpoints']}/marks"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = _marks(spark, notes, number)
        raw = _store(raw_rows(batch), paths["raw"], number, ["partition"])
        rows = reprocess(raw, model=model)
        if marks:
            watermark = max(latest for _, latest in marks) - delay
            marks = [mark for mark in marks if mark[1] > watermark]
            live = F.unix_micros("event_time") > watermark
            known = read_batches(spark, paths["processed"], PROCESSED, [n for n, _ in marks])
            rows = rows.filter(live).join(known.filter(live).select(*KEY), KEY, "left_anti")
        kept = _store(rows.select(*PROCESSED.fieldNames()), paths["processed"], number, DAYS)
        _store(alerts(kept), paths["alerts"], number, DAYS)
        latest = kept.agg(F.max(F.unix_micros("event_time"))).first()[0]
        if latest is not None:
            marks.append((number, latest))
        spark.createDataFrame(marks, MARKS).coalesce(1).write.mode("overwrite").parquet(f"{notes}/batch={number}")
        storage.remove(spark, f"{notes}/batch={number - 2}")
        if written is not None:
            written(number)

    return write


def start_zones(
    source: DataFrame,
    paths: dict[str, str],
    watermark: str = WATERMARK,
    trigger: dict | None = None,
    model: PipelineModel | None = None,
    written: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """One query that writes all zones. ``paths``: raw, processed, alerts, checkpoints."""
    delay = _micros(source.sparkSession, watermark)
    return (
        source.writeStream.queryName("zones")
        .foreachBatch(batch_writer(paths, delay, model, written))
        .option("checkpointLocation", f"{paths['checkpoints']}/zones")
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
