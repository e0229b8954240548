"""Fixed reference values: the food table, imputation profiles and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values -----------------------------------------------------------
# food, safe max °C, stream median °C, batch median °C, max shelf life in hours
FOODS = [
    ("Apple", 7.0, 12.0, 9.74, 720.0),
    ("Beef", 4.0, 11.2, 8.92, 120.0),
    ("Bread", 23.0, 21.0, 21.03, 168.0),
    ("Cheese", 6.0, 10.6, 9.14, 504.0),
    ("Chicken", 4.0, 11.0, 8.83, 48.0),
    ("Eggs", 6.0, 11.0, 10.08, 504.0),
    ("Fish", 3.0, 10.8, 7.96, 48.0),
    ("Milk", 5.0, 10.5, 8.37, 168.0),
    ("Mushroom", 6.0, 11.3, 10.55, 168.0),
    ("Orange", 8.0, 12.4, 12.07, 504.0),
    ("Potato", 10.0, 13.5, 14.01, 720.0),
    ("Spinach", 5.0, 11.1, 9.10, 120.0),
    ("Strawberry", 5.0, 10.9, 8.64, 72.0),
    ("Tomato", 10.0, 13.8, 14.10, 168.0),
    ("Yogurt", 5.0, 10.7, 9.35, 336.0),
]
FOOD_NAMES = [row[0] for row in FOODS]

# Used for a food that is not in the table above.
UNKNOWN_FOOD = {
    "safe_max_c": 6.0,
    "stream_median_c": 11.0,
    "batch_median_c": 11.0,
    "max_shelf_h": 168.0,
}

# Fills for missing readings other than temperature.
FILLS = {
    "stream": {"humidity": 63.0, "methane": 38.0, "co2": 870.0, "storage_days": 3.0},
    "batch": {"humidity": 63.16, "methane": 44.25, "co2": 882.52, "storage_days": 4.54},
}

# Valid physical range of each reading.
RANGES = {
    "temperature": (-5.0, 35.0),
    "humidity": (20.0, 100.0),
    "methane": (0.0, 180.0),
    "co2": (300.0, 2400.0),
    "storage_days": (0.0, 15.0),
}

DEFAULT_FOOD = "Chicken"
SEED_TRUCK = "TRK-000"
DEMO_TRUCK = "TRK-DEMO"
CLASS_NAMES = ["Fresh", "At Risk", "Spoiled"]
ALERT_THRESHOLD = 0.70
WATERMARK = "5 minutes"
TRIGGER = "30 seconds"
MAX_PER_TRIGGER = 5000
ALERT_LOOKBACK_HOURS = 2
FLEET_LOOKBACK_HOURS = 3
HISTORY_RETAIN_HOURS = 48
STALE_AFTER_MINUTES = 20
SEQUENCE_LENGTH = 10
HOLDOUT_TRUCKS = 5
# ----------------------------------------------------------------------------

FOOD_REF_COLUMNS = ["safe_max_c", "stream_median_c", "batch_median_c", "max_shelf_h"]


def food_ref(spark: SparkSession) -> DataFrame:
    """The 15-row food dimension.

    Written as an inline VALUES table, so that it is a LocalRelation of known
    size and Catalyst broadcasts it without a hint.
    """
    rows = ", ".join(
        f"('{food}', {safe}D, {stream}D, {batch}D, {shelf}D)"
        for food, safe, stream, batch, shelf in FOODS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(food_name, {', '.join(FOOD_REF_COLUMNS)})"
    )
