"""The sync jobs with a database as the serving store."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from freshhaul.operators.cleaning import lookback
from freshhaul.operators.merge import new_only
from freshhaul.plans.sync import fleet_snapshot, new_alerts
from freshhaul.reference import (
    ALERT_LOOKBACK_HOURS,
    FLEET_LOOKBACK_HOURS,
    HISTORY_RETAIN_HOURS,
)
from freshhaul.schemas import FLEET_COLUMNS, HISTORY_COLUMNS
from freshhaul.sinks.jdbc import (
    append_jdbc,
    execute,
    merge_statement,
    prune_statement,
    stage_jdbc,
)
from freshhaul.sources.files import read_zone_or_none
from freshhaul.sources.jdbc import read_known_ids


def sync_alerts_jdbc(
    spark: SparkSession,
    alerts_path: str,
    url: str,
    table: str,
    props: dict[str, str],
    now: datetime,
    hours: float = ALERT_LOOKBACK_HOURS,
) -> None:
    """Append alerts whose event id the table does not hold; the ids come by a pushed-down query."""
    zone = read_zone_or_none(spark, alerts_path)
    recent = None if zone is None else lookback(zone, now, hours)
    if recent is None or recent.isEmpty():
        return
    stored = read_known_ids(spark, url, table, props)
    append_jdbc(new_alerts(recent, stored, now), url, table, props)


def sync_fleet_jdbc(
    spark: SparkSession,
    processed_path: str,
    url: str,
    fleet_table: str,
    history_table: str,
    props: dict[str, str],
    now: datetime,
    hours: float = FLEET_LOOKBACK_HOURS,
    retain_hours: float = HISTORY_RETAIN_HOURS,
) -> None:
    """Stage and merge the fleet rows, append new history rows, delete expired ones."""
    zone = read_zone_or_none(spark, processed_path)
    if zone is None:
        return
    columns = list(dict.fromkeys(["event_id", *FLEET_COLUMNS, *HISTORY_COLUMNS]))
    recent = lookback(zone, now, hours).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if recent.isEmpty():
            return
        staging = f"{fleet_table}_staging"
        stage_jdbc(fleet_snapshot(recent), url, staging, props)
        merged = merge_statement(fleet_table, staging, FLEET_COLUMNS, "truck_id", "event_time")
        execute(spark, url, [merged, f"DROP TABLE IF EXISTS {staging}"], props)
        stored = read_known_ids(spark, url, history_table, props)
        fresh = new_only(recent.select(*HISTORY_COLUMNS), stored).filter(
            F.col("truck_id").isNotNull() & F.col("event_time").isNotNull()
        )
        append_jdbc(fresh, url, history_table, props)
        execute(spark, url, [prune_statement(history_table, retain_hours)], props)
    finally:
        recent.unpersist()
