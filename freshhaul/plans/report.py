"""Daily summary of the feature table."""

from __future__ import annotations

from datetime import datetime
from time import monotonic

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from freshhaul.sinks.tables import append_rows, run_log
from freshhaul.sources.files import read_zone_or_none


def daily_report(spark: SparkSession, features_path: str, runs_path: str, now: datetime) -> dict:
    """Label and risk distributions.

    A run without a feature table, or with one that cannot be read, is logged as failed.
    """
    started = monotonic()
    labels, risks, rows, status, error = [], [], 0, "failed", None
    try:
        zone = read_zone_or_none(spark, features_path)
        if zone is not None:
            # One pass: counts per (label, level), summed up from the small result.
            cells = (
                zone.groupBy("spoilage_label_name", "risk_level")
                .agg(F.count(F.lit(1)).alias("n"))
                .persist()
            )
            labels = cells.groupBy("spoilage_label_name").agg(F.sum("n").alias("row_count")).collect()
            risks = cells.groupBy("risk_level").agg(F.sum("n").alias("row_count")).collect()
            cells.unpersist()
            rows, status = sum(r["row_count"] for r in labels), "success"
    except (PySparkException, Py4JJavaError) as failure:
        error = str(failure)[:500]
    run_id = now.strftime("report_%Y%m%d_%H%M%S")
    seconds = int(monotonic() - started)
    append_rows(run_log(spark, "daily_report", run_id, status, rows, seconds, now), runs_path)
    return {
        "status": status,
        "error": error,
        "rows": rows,
        "labels": {r["spoilage_label_name"]: r["row_count"] for r in labels},
        "risks": {r["risk_level"]: r["row_count"] for r in risks},
    }
