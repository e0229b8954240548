"""Schemas and column contracts of the zones and serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshhaul.reference import FOOD_NAMES


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _I, _L, _TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType(),
)

# Message payload. All readings are doubles: a float32 parse would leak digits
# into every later double column.
SENSOR_EVENT = _struct(
    event_id=_S, truck_id=_S, timestamp=_S, gps_lat=_D, gps_lon=_D, food_name=_S,
    temperature=_D, humidity=_D, methane=_D, co2=_D, storage_days=_D,
    temp_humidity_index=_D, gas_spoilage_score=_D, methane_co2_ratio=_D,
    temp_deviation=_D, storage_risk_score=_D, spoiled=_I, source=_S,
)

# The fields that scoring needs: it derives the features anew from clean readings.
SENSOR_CORE = T.StructType(
    [
        SENSOR_EVENT[name]
        for name in (
            "event_id", "truck_id", "timestamp", "gps_lat", "gps_lon", "food_name",
            "temperature", "humidity", "methane", "co2", "storage_days", "spoiled",
        )
    ]
)

ENVELOPE = _struct(value=T.BinaryType(), topic=_S, partition=_I, offset=_L, timestamp=_TS)

RAW = _struct(raw_json=_S, kafka_timestamp=_TS, partition=_I, offset=_L)

SENSOR_CSV = _struct(
    event_id=_S, truck_id=_S, timestamp=_S, gps_lat=_D, gps_lon=_D, Food_Name=_S,
    Temperature=_D, Humidity=_D, Methane=_D, CO2=_D, Storage_Days=_D,
    temp_humidity_index=_D, gas_spoilage_score=_D, methane_co2_ratio=_D,
    temp_deviation=_D, storage_risk_score=_D, Spoiled=_I, source=_S,
)
CSV_RENAMES = {
    "Food_Name": "food_name", "Temperature": "temperature", "Humidity": "humidity",
    "Methane": "methane", "CO2": "co2", "Storage_Days": "storage_days", "Spoiled": "spoiled",
}

CORE_FEATURES = [
    "temp_humidity_index", "gas_spoilage_score", "methane_co2_ratio",
    "temp_deviation", "storage_risk_score",
]
SENSORS = ["temperature", "humidity", "methane", "co2", "storage_days"]
PARTITIONS = ["year", "month", "day", "hour"]

PROCESSED = _struct(
    event_id=_S, truck_id=_S, event_time=_TS, ingested_at=_TS, gps_lat=_D, gps_lon=_D,
    food_name=_S, temperature=_D, humidity=_D, methane=_D, co2=_D, storage_days=_D,
    temp_humidity_index=_D, gas_spoilage_score=_D, methane_co2_ratio=_D,
    temp_deviation=_D, storage_risk_score=_D, temp_breach_flag=_I,
    ml_predicted_class=_I, prob_spoiled=_D, risk_level=_S, spoiled=_I,
    kafka_partition=_I, kafka_offset=_L, year=_I, month=_I, day=_I, hour=_I,
)
PROCESSED_COLUMNS = PROCESSED.fieldNames()

ALERT_ZONE = T.StructType(
    PROCESSED.fields + _struct(alert_type=_S, alert_message=_S).fields
)

ONE_HOT_COLUMNS = [f"food_{name.lower()}" for name in FOOD_NAMES]
FEATURES = T.StructType(
    _struct(
        truck_id=_S, food_name=_S, hour_window=_TS, temp_avg=_D, temp_max=_D, temp_min=_D,
        temp_std=_D, humidity_avg=_D, humidity_max=_D, methane_avg=_D, methane_max=_D,
        co2_avg=_D, co2_max=_D, storage_days=_D, breach_count=_L, breach_rate=_D,
        readings_count=_L, temp_humidity_index=_D, gas_spoilage_score=_D,
        methane_co2_ratio=_D, temp_deviation=_D, storage_risk_score=_D,
        temp_volatility=_D, heat_gas_stress=_D, cumulative_breach_hours=_D,
    ).fields
    + _struct(**{name: _I for name in ONE_HOT_COLUMNS}).fields
    + _struct(
        spoilage_label=_I, spoilage_label_name=_S, risk_level=_S, last_lat=_D, last_lon=_D,
        year=_I, month=_I, day=_I, hour=_I,
    ).fields
)
FEATURE_COLUMNS = FEATURES.fieldNames()

# Serving tables: schema and the key that must be unique (None: append-only log).
ALERTS = _struct(
    event_id=_S, truck_id=_S, food_name=_S, temperature=_D, methane=_D, co2=_D,
    storage_days=_D, spoilage_prob=_D, predicted_class=_I, risk_level=_S,
    alert_message=_S, nearest_city=_S, gps_lat=_D, gps_lon=_D, created_at=_TS,
)
MODEL_METRICS = _struct(
    run_id=_S, model_name=_S, f1_score=_D, accuracy=_D, precision_val=_D,
    recall_val=_D, trained_at=_TS,
)
PIPELINE_RUNS = _struct(
    dag_id=_S, run_id=_S, status=_S, rows_processed=_L, duration_secs=_I, run_at=_TS,
)
FLEET_COLUMNS = [
    "truck_id", "food_name", "event_time", "temperature", "humidity", "methane", "co2",
    "storage_days", "temp_deviation", "gas_spoilage_score", "storage_risk_score",
    "risk_level", "gps_lat", "gps_lon",
]
FLEET_STATUS = T.StructType(
    [PROCESSED[name] for name in FLEET_COLUMNS] + [T.StructField("updated_at", _TS, True)]
)
READING_COLUMNS = ["event_time", "event_id", "food_name", *SENSORS, *CORE_FEATURES]
RECENT_READINGS = T.StructType(
    [
        T.StructField("truck_id", _S, True),
        T.StructField("readings", T.ArrayType(T.StructType([PROCESSED[n] for n in READING_COLUMNS])), True),
    ]
)
HISTORY_COLUMNS = [
    "event_id", "truck_id", "event_time", "temperature", "humidity", "methane", "co2",
]
SENSOR_HISTORY = T.StructType([PROCESSED[name] for name in HISTORY_COLUMNS])

REGISTRY = _struct(model=_S, version=_I, run_id=_S, stage=_S, metric=_D, direction=_S)

TABLE_KEYS = {
    "alerts": (ALERTS, None),
    "model_metrics": (MODEL_METRICS, None),
    "pipeline_runs": (PIPELINE_RUNS, None),
    "fleet_status": (FLEET_STATUS, "truck_id"),
    "sensor_history": (SENSOR_HISTORY, "event_id"),
    "registry": (REGISTRY, None),
    "recent_readings": (RECENT_READINGS, "truck_id"),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the contract: its columns in its order; fail if one is absent."""
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns absent from the frame: {missing}")
    return df.select(*schema.fieldNames())


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows that break the uniqueness of ``key`` (nulls are allowed to repeat)."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
