"""Sync of alerts and fleet state into the serving tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freshhaul.operators.alerts import to_alert_rows
from freshhaul.operators.cleaning import lookback
from freshhaul.operators.merge import known_among, new_only
from freshhaul.operators.windows import latest_by
from freshhaul.reference import (
    ALERT_LOOKBACK_HOURS,
    FLEET_LOOKBACK_HOURS,
    HISTORY_RETAIN_HOURS,
)
from freshhaul.schemas import FLEET_COLUMNS, HISTORY_COLUMNS
from freshhaul.session import scratch_of_job
from freshhaul.sinks.tables import (
    append_rows,
    drop_expired_days,
    drop_expired_rows,
    read_log,
    upsert_table,
)
from freshhaul.sources.files import read_zone_or_none


def new_alerts(recent: DataFrame, stored: DataFrame, now: datetime) -> DataFrame:
    """Rows to insert: recent alerts whose event is not stored yet."""
    return to_alert_rows(new_only(recent, known_among(stored, recent)), now)


def fleet_snapshot(recent: DataFrame) -> DataFrame:
    """Latest reading per truck, ties by event id."""
    return latest_by(recent, "truck_id", ["event_time", "event_id"]).select(*FLEET_COLUMNS)


def stored_since(log: DataFrame, now: datetime, hours: float) -> DataFrame:
    """Stored ids that an event of the look-back can have, by the days of the table's folders.

    Rows lie under the day of their event or, for alerts, of their insertion, which comes
    later. A day is allowed for clocks that differ.
    """
    if "year" in log.columns:
        since = (now - timedelta(hours=hours, days=1)).date()
        log = log.filter(F.make_date("year", "month", "day") >= F.lit(since))
    return log.select("event_id")


def _append_counted(df: DataFrame, path: str, time: str) -> int:
    """Append and count in the writing stage, whose tasks are counted once even when re-run."""
    seen = Observation()
    append_rows(df.observe(seen, F.count(F.lit(1)).alias("n")), path, time)
    return seen.get["n"]


def sync_alerts(
    spark: SparkSession,
    alerts_path: str,
    table_path: str,
    now: datetime,
    hours: float = ALERT_LOOKBACK_HOURS,
) -> int:
    """Insert new alerts; returns how many. No zone yet: nothing to do."""
    zone = read_zone_or_none(spark, alerts_path)
    if zone is None:
        return 0
    recent = lookback(zone, now, hours).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with scratch_of_job(spark):
            if recent.isEmpty():
                return 0
            stored = stored_since(read_log(spark, table_path, "alerts"), now, hours)
            return _append_counted(new_alerts(recent, stored, now), table_path, "created_at")
    finally:
        recent.unpersist()


def sync_fleet(
    spark: SparkSession,
    processed_path: str,
    fleet_path: str,
    history_path: str,
    now: datetime,
    hours: float = FLEET_LOOKBACK_HOURS,
    retain_hours: float = HISTORY_RETAIN_HOURS,
    rewrite_cutoff: bool = False,
) -> dict:
    """Upsert the fleet table, append new history rows, drop expired days.

    Readers never see expired rows of the day that the retention bound cuts through;
    ``rewrite_cutoff`` also takes them off the disk, at the cost of rewriting that day.
    """
    zone = read_zone_or_none(spark, processed_path)
    if zone is None:
        return {"history_rows": 0, "removed": []}
    columns = list(dict.fromkeys(["event_id", *FLEET_COLUMNS, *HISTORY_COLUMNS]))
    recent = lookback(zone, now, hours).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if recent.isEmpty():
            return {"history_rows": 0, "removed": []}
        with scratch_of_job(spark):
            upsert_table(spark, fleet_path, "fleet_status", fleet_snapshot(recent), "event_time", now)
            stored = stored_since(read_log(spark, history_path, "sensor_history"), now, hours)
            placed = recent.filter(F.col("truck_id").isNotNull() & F.col("event_time").isNotNull())
            fresh = new_only(placed.select(*HISTORY_COLUMNS), known_among(stored, placed))
            inserted = _append_counted(fresh, history_path, "event_time")
    finally:
        recent.unpersist()
    if rewrite_cutoff:
        drop_expired_rows(spark, history_path, now, retain_hours)
    return {
        "history_rows": inserted,
        "removed": drop_expired_days(spark, history_path, now, retain_hours),
    }
