"""Rows that came after the watermark: what the stream dropped, and how they come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from freshhaul.plans.readings import reprocess
from freshhaul.schemas import PROCESSED
from freshhaul.sources.files import read_zone, read_zone_or_none
from freshhaul.storage import names

DAYS = ["year", "month", "day"]


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query have dropped, by its recent progress."""
    return sum(
        int(operator.get("numRowsDroppedByWatermark") or 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def dropped(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Processed rows of the landed messages whose event the processed zone does not have.

    Only ids of the zone are read; a message that was cut out as invalid stays out.
    """
    return reprocess(raw).join(processed.select("event_id"), "event_id", "left_anti").select(
        *PROCESSED.fieldNames()
    )


def read_processed(spark: SparkSession, processed: str, late: str) -> DataFrame:
    """The processed zone with the rows recovered so far.

    They have a folder of their own: a reader of the stream's folder sees only files of
    its log.
    """
    zone = read_zone(spark, processed, PROCESSED)
    batches = sorted(n for n in names(spark, late) if n.startswith("batch="))
    for batch in batches:
        rows = read_zone_or_none(spark, f"{late}/{batch}")
        if rows is not None:
            zone = zone.unionByName(rows.select(*PROCESSED.fieldNames()))
    return zone


def recover(spark: SparkSession, raw: str, processed: str, late: str) -> int:
    """Add what the zone lacks as one more batch below ``late``; the number of rows.

    A run that failed half-way has left no finished batch that a reader takes for whole,
    as each is written to its number and a repeated run finds nothing that is there.
    """
    known = read_processed(spark, processed, late)
    number = len([n for n in names(spark, late) if n.startswith("batch=")])
    path = f"{late}/batch={number}"
    dropped(read_zone(spark, raw), known).write.mode("overwrite").partitionBy(*DAYS).parquet(path)
    found = read_zone_or_none(spark, path)
    return 0 if found is None else found.count()
