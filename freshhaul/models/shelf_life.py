"""Remaining shelf life from the last readings of a truck."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshhaul.operators.metrics import apply_scaler
from freshhaul.operators.sampling import holdout_keys, tasks_for
from freshhaul.operators.windows import last_n, latest_by, sequences
from freshhaul.reference import SEQUENCE_LENGTH
from freshhaul.schemas import CORE_FEATURES

STEP_INPUTS = ["temperature", "humidity", "methane", "co2", *CORE_FEATURES]
TARGET = "remaining_hours"
STOPPING = {"maxIter": 20, "validationTol": 0.01}  # trees at most, and the least gain of a tree


def training_sequences(df: DataFrame, n: int = SEQUENCE_LENGTH, tasks: int | None = None) -> DataFrame:
    block = 4096 if tasks is None else 1024  # small blocks fill the tasks evenly
    return sequences(df, "truck_id", ["event_time", "event_id"], STEP_INPUTS, TARGET, n, block=block, tasks=tasks)


def with_vector(df: DataFrame, column: str = "sequence") -> DataFrame:
    """Flatten the steps, oldest first, to one feature vector."""
    steps = F.transform(column, lambda step: F.array(*[step[c] for c in STEP_INPUTS]))
    return df.withColumn("features", array_to_vector(F.flatten(steps)))


def train_shelf_life(
    df: DataFrame, n: int = SEQUENCE_LENGTH, stop_trucks: int = 0, **params: object
) -> GBTRegressionModel:
    """Boosted trees on standardised readings; the last truck rows give no target.

    With ``stop_trucks`` the last trucks in sorted order are kept out of the fit: boosting
    stops where their error no longer falls by ``validationTol``, and the trees up to the
    least error stay. Where no other truck is left to fit on, it does not stop early.
    All trees read the sequences, which Spark keeps: their tasks are sized by rows.
    """
    tasks = tasks_for(df, df.count())
    cut = training_sequences(df, n, tasks if tasks > 1 else None)
    rows = with_vector(cut).select("truck_id", "features", TARGET)
    if stop_trucks:
        fitted, held = holdout_keys(rows, "truck_id", stop_trucks)
        if not fitted.isEmpty():
            marked = fitted.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
            stopping = {"validationIndicatorCol": "held", **STOPPING}
            return GBTRegressor(labelCol=TARGET, **{"seed": 42, **stopping, **params}).fit(marked)
    return GBTRegressor(labelCol=TARGET, **{"seed": 42, **params}).fit(rows)


def predict_sequences(df: DataFrame, model: GBTRegressionModel, column: str = "sequence") -> DataFrame:
    out = model.transform(with_vector(df, column))
    hours = F.round(F.greatest(F.lit(0.0), F.col("prediction")), 1)
    return out.select(*df.columns, hours.alias("predicted_hours"))


def predict_latest(df: DataFrame, model: GBTRegressionModel, n: int = SEQUENCE_LENGTH) -> DataFrame:
    """Prediction per truck from its last ``n`` rows; trucks with fewer get none."""
    latest = last_n(df, "truck_id", ["event_time", "event_id"], n, STEP_INPUTS, "sequence")
    return predict_sequences(latest, model).select("truck_id", "predicted_hours")


def latest_or_rule(
    df: DataFrame, fitted: tuple[GBTRegressionModel, DataFrame] | None, n: int = SEQUENCE_LENGTH
) -> DataFrame:
    """Hours left per truck: from the model where it has enough readings, else by the formula.

    ``fitted``: regressor and the scaler of its inputs, None while none is in production.
    ``df`` has the formula's hours of each reading as ``remaining_hours``.
    """
    latest = latest_by(df, "truck_id", ["event_time", "event_id"])
    ruled = latest.select("truck_id", F.round(F.greatest(F.lit(0.0), TARGET), 1).alias("_rule"))
    if fitted is None:
        return ruled.select("truck_id", F.col("_rule").alias("hours"), F.lit("rule").alias("source"))
    model, stats = fitted
    predicted = predict_latest(apply_scaler(df, stats, STEP_INPUTS), model, n)
    known = F.col("predicted_hours").isNotNull()
    return ruled.join(predicted, "truck_id", "left").select(
        "truck_id",
        F.coalesce("predicted_hours", "_rule").alias("hours"),
        F.when(known, "model").otherwise("rule").alias("source"),
    )
