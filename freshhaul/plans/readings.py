"""Message-to-processed logic, shared by the stream, reprocessing and batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from freshhaul.models.classifier import model_score
from freshhaul.operators.cleaning import (
    clip_ranges,
    dedupe,
    default_food,
    impute,
    valid_rows,
    with_event_time,
    with_ingest_time,
    with_partitions,
)
from freshhaul.operators.enrich import with_food_ref
from freshhaul.operators.featurize import breach_flag, core_features, scored
from freshhaul.schemas import PROCESSED, SENSOR_CORE, conform
from freshhaul.sources.kafka import decode_envelope, envelope_of_raw, parse_readings


def cleaned(df: DataFrame, profile: str, dim: DataFrame | None = None) -> DataFrame:
    """Impute and clip; attaches the food columns that later steps need in the same join."""
    rated = with_food_ref(df, f"{profile}_median_c", "safe_max_c", dim=dim)
    return clip_ranges(impute(rated, profile)).drop(f"{profile}_median_c")


def scored_readings(
    df: DataFrame, model: PipelineModel | None = None, dim: DataFrame | None = None
) -> DataFrame:
    """Features, breach flag, class, probability and level of valid readings."""
    rated = breach_flag(core_features(cleaned(default_food(df), "stream", dim)))
    return (scored(rated) if model is None else model_score(rated, model)).drop("safe_max_c")


def processed(
    decoded: DataFrame,
    watermark: str | None = None,
    model: PipelineModel | None = None,
    dim: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Decoded messages to rows of the processed zone."""
    timed = with_event_time(parse_readings(decoded, SENSOR_CORE))
    if watermark:
        timed = timed.withWatermark("event_time", watermark)
    out = scored_readings(dedupe(valid_rows(timed)), model, dim)
    return conform(with_partitions(with_ingest_time(out), now), PROCESSED)


def process_messages(envelopes: DataFrame, **options: object) -> DataFrame:
    return processed(decode_envelope(envelopes), **options)


def reprocess(raw: DataFrame, **options: object) -> DataFrame:
    """Run the same logic over the raw zone, e.g. for rows a watermark has dropped."""
    return processed(envelope_of_raw(raw), **options)
