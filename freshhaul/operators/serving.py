"""Queries behind the dashboard."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.functions import rules
from freshhaul.functions.times import moment
from freshhaul.reference import SEED_TRUCK, STALE_AFTER_MINUTES


def fleet_view(fleet: DataFrame) -> DataFrame:
    """Fleet rows under their display names, with class, label and time of day."""
    cls = rules.level_to_class(F.col("risk_level"))
    renamed = {"storage_risk_score": "risk_score", "gps_lat": "lat", "gps_lon": "lon"}
    return (
        fleet.withColumnsRenamed(renamed)
        .withColumn("spoiled_class", cls)
        .withColumns(
            {
                "risk_label": rules.class_name(F.col("spoiled_class")),
                "last_update": F.date_format("event_time", "HH:mm:ss"),
            }
        )
    )


def filter_fleet(
    df: DataFrame, labels: list[str] | None = None, foods: list[str] | None = None
) -> DataFrame:
    """Trucks of the chosen labels and foods; None leaves a choice open, an empty one has none."""
    for name, chosen in (("risk_label", labels), ("food_name", foods)):
        if chosen is not None:
            df = df.filter(F.col(name).isin(chosen))
    return df


def drop_seed_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("truck_id") != SEED_TRUCK)


def truck_history(df: DataFrame, truck_id: str, now: datetime, hours: float = 24) -> DataFrame:
    since = moment(now - timedelta(hours=hours), df.schema["event_time"].dataType)
    return (
        df.filter((F.col("truck_id") == truck_id) & (F.col("event_time") >= since))
        .select(F.col("event_time").alias("timestamp"), "temperature", "humidity", "methane", "co2")
        .orderBy("timestamp")
    )


def fleet_kpis(df: DataFrame) -> DataFrame:
    """Totals, per-class counts and shares, mean risk."""
    total = F.count(F.lit(1))
    counts = {
        name: F.count_if(F.col("spoiled_class") == cls)
        for cls, name in enumerate(("fresh", "at_risk", "spoiled"))
    }
    return df.agg(
        total.alias("total"),
        *[n.alias(f"n_{name}") for name, n in counts.items()],
        *[
            F.when(total > 0, n / total).alias(f"share_{name}") for name, n in counts.items()
        ],
        F.avg("risk_score").alias("avg_risk"),
    )


def mean_risk_by_food(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("food_name")
        .agg(F.avg("risk_score").alias("risk_score"))
        .orderBy("risk_score", "food_name")
    )


def alerts_over_time(df: DataFrame, every: str = "30 minutes", column: str = "created_at") -> DataFrame:
    """Alerts per time bucket and level."""
    return (
        df.groupBy(F.window(column, every).alias("w"), "risk_level")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .select(F.col("w.start").alias("bucket"), "risk_level", "alert_count")
    )


def alert_counts(df: DataFrame) -> DataFrame:
    critical = F.col("risk_level") == "CRITICAL"
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(critical).alias("critical"),
        F.count_if(~F.coalesce(critical, F.lit(False))).alias("warning"),
    )


def histogram(df: DataFrame, column: str, bins: int, by: str) -> DataFrame:
    """Counts per equal-width bin between min and max, and per ``by``.

    The bounds are scalar subqueries of one aggregate; the maximum falls in the last bin.
    """
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    width = (high - low) / F.lit(float(bins))
    number = F.when(
        width > 0, F.least(F.lit(bins - 1), F.floor((F.col(column) - low) / width).cast("int"))
    ).otherwise(F.lit(0))
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(number.alias("bin"), by)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counts.select(
        "bin",
        by,
        "row_count",
        (low + F.col("bin") * width).alias("bin_from"),
        (low + (F.col("bin") + 1) * width).alias("bin_to"),
    )


def freshness(
    df: DataFrame, ts: str, now: datetime, max_minutes: float = STALE_AFTER_MINUTES
) -> DataFrame:
    """Newest time, rows, minutes behind ``now`` and whether that is within bounds."""
    newest = df.agg(F.max(ts).alias("last_update"), F.count(F.lit(1)).alias("row_count"))
    at = moment(now, df.schema[ts].dataType)
    minutes = F.timestamp_diff("MICROSECOND", F.col("last_update"), at) / F.lit(60_000_000.0)
    return newest.withColumn("minutes_behind", minutes).withColumn(
        "is_fresh", F.col("minutes_behind") <= max_minutes
    )
