"""The streaming pipeline over file sources."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from freshhaul.catalog import fixtures as fx
from freshhaul.plans.readings import process_messages, reprocess
from freshhaul.schemas import ENVELOPE, PROCESSED
from freshhaul.sources.kafka import read_envelope_files
from freshhaul.streaming import pipeline

ONCE = {"availableNow": True}


def paths_in(folder):
    return {n: str(folder / n) for n in ("raw", "processed", "alerts", "checkpoints")}


def message(event_id, at, **extra):
    body = {"event_id": event_id, "truck_id": "TRK-001", "timestamp": at, "food_name": "Milk",
            "temperature": 4.0, **extra}
    return json.dumps(body)


def deliver(spark, path, texts, start=0):
    """One file of messages, as one micro-batch."""
    rows = [(bytearray(t.encode()), "sensor-raw", 0, start + i, None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def run(spark, source, paths, **options):
    stream = read_envelope_files(spark, source, max_files=1)
    queries = pipeline.stream_pipeline(stream, paths, trigger=ONCE, **options)
    for query in queries.values():
        query.awaitTermination()
    return queries


def ids(spark, path):
    return sorted(r["event_id"] for r in spark.read.schema(PROCESSED).parquet(path).collect())


@pytest.mark.parametrize("chain", [False, True])
def test_stream_equals_batch(spark, readings, tmp_path, chain):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    messages = fx.envelopes(fx.deliveries(fx.dirty(readings)))
    messages.coalesce(1).write.parquet(source)
    run(spark, source, paths, chain_alerts=chain)

    zone = spark.read.schema(PROCESSED).parquet(paths["processed"])
    stored = spark.read.parquet(source)
    batch = process_messages(stored)
    ignored = ("ingested_at", "kafka_offset", "kafka_partition")
    assert zone.drop(*ignored).exceptAll(batch.drop(*ignored)).count() == 0
    assert zone.count() == batch.count() > 0
    raised = batch.filter("prob_spoiled >= 0.7 OR ml_predicted_class = 2 OR temp_breach_flag = 1")
    assert spark.read.parquet(paths["alerts"]).count() == raised.count()
    raw = spark.read.parquet(paths["raw"])
    assert raw.count() == messages.count()
    assert reprocess(raw).count() == batch.count()


def test_duplicates_junk_and_restart(spark, tmp_path):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    deliver(spark, source, [message("a", "2024-01-31 00:20:00"), message("a", "2024-01-31 00:20:00"),
                            "{junk", message("bad", "yesterday"), message("none", "2024-01-31 00:20:00", temperature=None)])
    run(spark, source, paths)
    assert ids(spark, paths["processed"]) == ["a"]
    # Restart: the checkpoint remembers both the files and the ids seen.
    deliver(spark, source, [message("a", "2024-01-31 00:20:00"), message("b", "2024-01-31 00:21:00")], 5)
    run(spark, source, paths)
    assert ids(spark, paths["processed"]) == ["a", "b"]
    assert spark.read.parquet(paths["raw"]).count() == 7


def test_late_rows(spark, tmp_path):
    """The watermark lags one batch: it takes effect on the file after next."""
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    minute = "2024-01-31 00:{}".format
    files = [
        [message("t20", minute("20:00"))],
        [message("t40", minute("40:00")), message("late01-kept", minute("01:00"))],
        [message("t41", minute("41:00")), message("late01", minute("01:00")),
         message("late14", minute("14:59")), message("t25", minute("25:00"))],
    ]
    for texts in files:
        deliver(spark, source, texts)
    stream = read_envelope_files(spark, source, max_files=1)
    query = pipeline.start_processed(
        process_messages(stream, watermark="5 minutes"), paths["processed"], paths["checkpoints"], ONCE
    )
    query.awaitTermination()
    dropped = [
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    ]
    assert ids(spark, paths["processed"]) == ["late01-kept", "t20", "t25", "t40", "t41"]
    assert sum(dropped) == 2


def test_partition_layout_and_console(spark, tmp_path):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    deliver(spark, source, [message("a", "2024-02-01 03:00:00", temperature=20.0)])
    run(spark, source, paths, console=True)
    assert (tmp_path / "processed" / "year=2024" / "month=2" / "day=1").is_dir()
    assert (tmp_path / "alerts" / "year=2024" / "month=2" / "day=1").is_dir()
    assert (tmp_path / "raw" / "partition=0").is_dir()
    row = spark.read.parquet(paths["processed"]).first()
    assert row["ingested_at"] is not None and row["hour"] == 3


def test_state_backend_and_shuffle_in_plan(spark, readings):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    plan = process_messages(fx.envelopes(readings))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan and plan.count("BroadcastHashJoin") == 1


def test_model_can_score_a_stream(spark, readings, tmp_path):
    from freshhaul.models.classifier import train_classifier

    model = train_classifier(fx.rated(readings), numTrees=3, maxDepth=4)
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    fx.envelopes(readings).coalesce(1).write.parquet(source)
    run(spark, source, paths, model=model)
    zone = spark.read.schema(PROCESSED).parquet(paths["processed"])
    batch = process_messages(spark.read.parquet(source), model=model)
    columns = ["event_id", "ml_predicted_class", "prob_spoiled", "risk_level"]
    assert zone.select(*columns).exceptAll(batch.select(*columns)).count() == 0
    assert zone.agg(F.count_distinct("prob_spoiled")).first()[0] > 3


def test_await_any_stops_the_others(spark, tmp_path):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    deliver(spark, source, [message("a", "2024-02-01 03:00:00")])
    stream = read_envelope_files(spark, source)
    queries = {
        "short": pipeline.start_raw(stream, paths["raw"], str(tmp_path / "c1"), ONCE),
        "long": pipeline.start_processed(
            process_messages(stream), paths["processed"], str(tmp_path / "c2"), {"processingTime": "1 second"}
        ),
    }
    pipeline.await_any(spark, queries, every=1)
    assert not any(query.isActive for query in queries.values())
