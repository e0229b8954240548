"""Alert selection, typing, message, serving projection and display."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.functions import rules
from freshhaul.functions.times import moment
from freshhaul.reference import ALERT_THRESHOLD


def alerts(df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Readings that raise an alert, with its type and message.

    The message is null when any of its parts is null.
    """
    risky = F.col("prob_spoiled") >= threshold
    spoiled = F.col("ml_predicted_class") == 2
    return df.filter(risky | spoiled | (F.col("temp_breach_flag") == 1)).withColumns(
        {
            "alert_type": F.when(spoiled, "ML_SPOILED")
            .when(risky, "ML_HIGH_RISK")
            .otherwise("TEMP_BREACH"),
            "alert_message": F.concat(
                F.lit("ALERT: "), "truck_id",
                F.lit(" | "), "food_name",
                F.lit(" | Temp="), F.col("temperature").cast("string"),
                F.lit("°C | ML_class="), F.col("ml_predicted_class").cast("string"),
                F.lit(" | Prob_Spoiled="), F.col("prob_spoiled").cast("string"),
                F.lit(" | Level="), "risk_level",
            ),
        }
    )


def to_alert_rows(df: DataFrame, created_at: datetime | None = None) -> DataFrame:
    """Rows of the alert table. Its ``spoilage_prob`` holds the risk score, by contract."""
    made = F.current_timestamp() if created_at is None else moment(created_at)
    return df.select(
        "event_id", "truck_id", "food_name", "temperature", "methane", "co2", "storage_days",
        F.col("storage_risk_score").alias("spoilage_prob"),
        rules.level_to_class(F.col("risk_level")).alias("predicted_class"),
        "risk_level",
        "alert_message",
        F.lit(None).cast("string").alias("nearest_city"),
        "gps_lat", "gps_lon",
        made.alias("created_at"),
    )


def alert_display(df: DataFrame) -> DataFrame:
    """Alert table columns as shown to a reader; every level but CRITICAL shows as WARNING."""
    critical = F.col("risk_level") == "CRITICAL"
    percent = F.format_string("%.1f%%", F.round(F.col("spoilage_prob") * 100, 1))
    return df.select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("time"),
        F.col("truck_id").alias("truck"),
        F.col("food_name").alias("food"),
        F.col("temperature").alias("temp"),
        "methane",
        F.when(critical, "🔴 CRITICAL").otherwise("🟠 WARNING").alias("risk"),
        F.when(F.col("spoilage_prob").isNull(), "—").otherwise(percent).alias("probability"),
        F.when(critical, "Reroute dispatched").otherwise("Alert sent").alias("action"),
    )
