"""Hourly feature build."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from time import monotonic

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.operators.cleaning import ensure_column, lookback
from freshhaul.operators.featurize import (
    core_features,
    derived_features,
    label_hours,
    label_names,
    one_hot,
    risk_tiers,
)
from freshhaul.operators.quality import flagged_nulls, null_totals, with_null_flags
from freshhaul.operators.rollup import distribution, food_risk, hourly
from freshhaul.operators.sampling import top_n
from freshhaul.plans.readings import cleaned
from freshhaul.reference import DEMO_TRUCK
from freshhaul.schemas import FEATURES, conform
from freshhaul.sinks.files import write_features, write_report
from freshhaul.sinks.tables import append_rows, run_log
from freshhaul.sources.files import read_readings_csv, read_zone_or_none


def hour_groups(
    df: DataFrame, dim: DataFrame | None = None, extra: Sequence[Column] = ()
) -> DataFrame:
    """Readings (with partition columns), cleaned and rolled up by hour."""
    return hourly(cleaned(ensure_column(df, "truck_id", DEMO_TRUCK), "batch", dim), dim, extra)


def features_of_hours(hours: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Rolled-up hours to rows of the feature table."""
    rated = core_features(
        hours, "temp_avg", "humidity_avg", "methane_avg", "co2_avg", "storage_days", "temp_max", dim
    )
    labelled = label_names(label_hours(derived_features(rated)))
    return conform(one_hot(risk_tiers(labelled)), FEATURES)


def hourly_features(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    return features_of_hours(hour_groups(df, dim), dim)


def feature_window(df: DataFrame, now: datetime, hours: float, mode: str = "event_time") -> DataFrame:
    """Look-back whose start is rounded down to the hour.

    The write replaces whole hours, so a partly read first hour would lose rows.
    """
    start = (now - timedelta(hours=hours)).replace(minute=0, second=0, microsecond=0)
    return lookback(df, now, (now - start) / timedelta(hours=1), mode)


def _log_run(
    spark: SparkSession, path: str | None, run_id: str, status: str, rows: int, started: float, now: datetime
) -> None:
    """A row in the run log, where one is kept; empty windows and failures have theirs too."""
    if path is not None:
        seconds = int(monotonic() - started)
        append_rows(run_log(spark, "feature_build", run_id, status, rows, seconds, now), path)


def feature_build(
    spark: SparkSession,
    processed_path: str,
    features_path: str,
    reports_path: str,
    now: datetime,
    hours: float = 24,
    fallback_csv: str | None = None,
    runs_path: str | None = None,
    mode: str = "event_time",
) -> dict:
    """Build, write and report the features of the last ``hours``.

    The input is read once. The null profile and the row counts are aggregates
    of the same pass, summed up from the persisted hours; they do not count
    twice when a lost executor's tasks run again, as accumulators may.
    """
    started = monotonic()
    run_id = now.strftime("batch_%Y%m%d_%H%M%S")
    zone = read_zone_or_none(spark, processed_path)
    source = None if zone is None else feature_window(zone, now, hours, mode)
    if source is None or source.isEmpty():
        if fallback_csv is None:
            _log_run(spark, runs_path, run_id, "success", 0, started, now)
            return {"run_id": run_id, "input_rows": 0, "output_rows": 0, "quality": {}}
        source = read_readings_csv(spark, fallback_csv, stamp_now=True)

    hours_seen = hour_groups(with_null_flags(source), extra=flagged_nulls())
    hours_seen = hours_seen.persist(StorageLevel.MEMORY_AND_DISK)
    features = features_of_hours(hours_seen)
    report = f"{reports_path}/batch_report_{run_id}"
    try:
        write_features(features, features_path)
        counts = hours_seen.agg(
            F.count(F.lit(1)).alias("hours"), F.sum("readings_count").alias("readings")
        ).first()
        profile = null_totals(hours_seen).first().asDict()
        risks = food_risk(features)
        write_report(distribution(features, "spoilage_label_name"), f"{report}/label_distribution")
        write_report(distribution(features, "risk_level"), f"{report}/risk_distribution")
        write_report(risks, f"{report}/food_risk_summary")
        riskiest = top_n(risks, [F.desc("avg_risk_score"), "food_name"], 5).collect()
    except Exception:
        _log_run(spark, runs_path, run_id, "failed", 0, started, now)
        raise
    finally:
        hours_seen.unpersist()
    _log_run(spark, runs_path, run_id, "success", counts["hours"], started, now)
    return {
        "run_id": run_id,
        "input_rows": counts["readings"],
        "output_rows": counts["hours"],
        "quality": profile,
        "riskiest_foods": [row["food_name"] for row in riskiest],
        "report_path": report,
    }
