"""Inputs of the registered queries, all derived from the ``events`` table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.functions.times import moment
from freshhaul.operators.alerts import alerts
from freshhaul.operators.cleaning import with_partitions
from freshhaul.operators.enrich import with_food_ref
from freshhaul.operators.featurize import core_features, shelf_life
from freshhaul.operators.windows import latest_by
from freshhaul.plans.features import hourly_features
from freshhaul.plans.readings import cleaned, scored_readings
from freshhaul.schemas import FLEET_COLUMNS
from freshhaul.sinks.files import message_json

NOW = datetime(2024, 2, 1, 12, 0, 0)

READINGS = """
SELECT concat('EVT-', lpad(CAST(event_id AS STRING), 8, '0')) AS event_id,
       concat('TRK-', lpad(CAST(user_id % 25 AS STRING), 3, '0')) AS truck_id,
       timestampadd(MICROSECOND,
                    timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 20,
                    TIMESTAMP_NTZ'2024-01-31 00:00:00') AS event_time,
       8D + (event_id * 11 % 2900) / 100D AS gps_lat,
       68D + (event_id * 13 % 2900) / 100D AS gps_lon,
       element_at(array('Apple','Beef','Bread','Cheese','Chicken','Eggs','Fish','Milk','Mushroom',
                        'Orange','Potato','Spinach','Strawberry','Tomato','Yogurt'),
                  CAST(user_id % 15 AS INT) + 1) AS food_name,
       CASE WHEN event_id % 200 = 0 THEN NULL WHEN event_id % 997 = 0 THEN 99D
            ELSE (event_id * 37 % 3191) / 100D - 1.28D END AS temperature,
       CASE WHEN event_id % 201 = 0 THEN NULL
            ELSE 32D + (event_id * 53 % 6801) / 100D END AS humidity,
       CASE WHEN event_id % 203 = 0 THEN NULL ELSE value END AS methane,
       CASE WHEN event_id % 207 = 0 THEN NULL
            ELSE 304.68D + CAST(get_json_object(props, '$.k') AS INT) * 20D END AS co2,
       CASE WHEN event_id % 209 = 0 THEN NULL
            ELSE (event_id * 7 % 1501) / 100D END AS storage_days,
       CAST(CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 2
                            WHEN 'view' THEN 1 ELSE 0 END AS INT) AS spoiled
FROM {events}
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READINGS, events=events(spark, sf_dir))


def number() -> Column:
    """Numeric part of an event id."""
    return F.substring("event_id", 5, 20).cast("long")


def truck_number() -> Column:
    return F.substring("truck_id", 5, 10).cast("int")


def deliveries(df: DataFrame) -> DataFrame:
    """Every odd event delivered twice."""
    return df.unionAll(df.filter(number() % 2 == 1))


def dirty(df: DataFrame) -> DataFrame:
    gone = number() % 311 == 0
    spoilt = {n: F.when(~gone, F.col(n)) for n in ("temperature", "methane", "co2")}
    return df.withColumns(
        {
            "truck_id": F.when(number() % 301 != 0, F.col("truck_id")),
            "food_name": F.when(number() % 307 != 0, F.col("food_name")),
            **spoilt,
        }
    )


def unknown_food(df: DataFrame) -> DataFrame:
    food = F.when(number() % 101 == 0, "Durian").otherwise(F.col("food_name"))
    return df.withColumn("food_name", food)


def known(df: DataFrame) -> DataFrame:
    return df.filter(number() % 3 == 0).select("event_id")


def envelopes(df: DataFrame) -> DataFrame:
    """Messages in the columns of the Kafka source; every 313th is not JSON."""
    junk = F.when(number() % 313 == 0, F.lit("{not json")).otherwise(message_json(df))
    return df.select(
        junk.cast("binary").alias("value"),
        F.lit("sensor-raw").alias("topic"),
        (number() % 8).cast("int").alias("partition"),
        number().alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )


def processed(df: DataFrame) -> DataFrame:
    """Scored readings with partition columns (batch form of the processed zone)."""
    return with_partitions(scored_readings(df))


def alert_zone(df: DataFrame) -> DataFrame:
    return alerts(processed(df))


def features(df: DataFrame) -> DataFrame:
    return hourly_features(with_partitions(df))


def rated(df: DataFrame) -> DataFrame:
    """Cleaned readings with features and remaining shelf life, for the models."""
    rows = with_food_ref(df, "batch_median_c", "safe_max_c", "max_shelf_h")
    return shelf_life(core_features(cleaned(rows, "batch"))).drop("safe_max_c", "max_shelf_h")


def fleet(df: DataFrame) -> DataFrame:
    latest = latest_by(processed(df), "truck_id", ["event_time", "event_id"])
    return latest.select(*FLEET_COLUMNS, F.col("event_time").alias("updated_at"))


def fleet_before(df: DataFrame) -> DataFrame:
    """The stored fleet table: state at 18:00 of the first day, a seventh of the trucks absent."""
    early = df.filter(F.col("event_time") < moment(datetime(2024, 1, 31, 18), "timestamp_ntz"))
    return fleet(early).filter(truck_number() % 7 != 0)


def fleet_updates(df: DataFrame) -> DataFrame:
    """Newer state for most trucks, the same state for a quarter, none for a fifth.

    Besides, an older state of the updated trucks and states without a truck: both are
    to change nothing.
    """
    stored = fleet_before(df)
    newer = fleet(df).filter(truck_number() % 4 != 1)
    valid = newer.unionByName(stored.filter(truck_number() % 4 == 1)).filter(truck_number() % 5 != 0)
    older = stored.filter((truck_number() % 4 != 1) & (truck_number() % 5 != 0))
    lost = newer.withColumn("truck_id", F.lit(None).cast("string"))
    return valid.unionByName(older).unionByName(lost).select(*FLEET_COLUMNS)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model versions: 60 models, direction by model, a stage and metric per version."""
    return events(spark, sf_dir).selectExpr(
        "concat('model-', lpad(CAST(user_id % 60 AS STRING), 2, '0')) AS model",
        "CAST(event_id AS INT) AS version",
        "concat('run-', CAST(event_id AS STRING)) AS run_id",
        "CASE WHEN user_id % 60 % 6 = 5 THEN 'None' WHEN event_id % 11 = 0 THEN 'Production'"
        " WHEN event_id % 5 = 0 THEN 'Archived' ELSE 'None' END AS stage",
        "CASE WHEN event_id % 4 = 0 THEN NULL ELSE round(value / 50D, 0) END AS metric",
        "CASE WHEN user_id % 60 % 2 = 0 THEN 'higher_is_better' ELSE 'lower_is_better' END"
        " AS direction",
    )


def predictions(df: DataFrame) -> DataFrame:
    label = F.coalesce("spoiled", "ml_predicted_class")
    shifted = (label + F.when(number() % 7 == 0, 1).otherwise(0)) % 3
    return processed(df).select("event_id", label.alias("y"), shifted.alias("p"))


def model_metrics(df: DataFrame) -> DataFrame:
    """A metrics log: one row per reading, model by truck."""
    return df.select(
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.concat(F.lit("model-"), "truck_id").alias("model_name"),
        F.col("gps_lat").alias("f1_score"),
        F.col("gps_lon").alias("accuracy"),
        F.col("event_time").alias("trained_at"),
    )
