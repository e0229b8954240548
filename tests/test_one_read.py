"""All zones from one read of the source."""

from __future__ import annotations

import json

import pytest

from freshhaul.schemas import ENVELOPE, PROCESSED
from freshhaul.sources.kafka import read_envelope_files
from freshhaul.streaming.one_read import read_batches, start_zones

ONCE = {"availableNow": True}


def deliver(spark, path, *events, start=0):
    rows = []
    for i, (event_id, at) in enumerate(events):
        body = {"event_id": event_id, "truck_id": "T", "timestamp": at, "food_name": "Milk", "temperature": 4.0}
        rows.append((bytearray(json.dumps(body).encode()), "sensor-raw", 0, start + i, None))
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def minute(m):
    return f"2024-01-31 00:{m:02d}:00"


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("in", "raw", "processed", "alerts", "checkpoints")}


def rows(spark, paths):
    zone = read_batches(spark, paths["processed"], PROCESSED)
    return sorted((r["event_id"], r["batch"]) for r in zone.collect())


def run(spark, paths, **options):
    query = start_zones(read_envelope_files(spark, paths["in"], max_files=1), paths, "5 minutes", ONCE, **options)
    query.awaitTermination()
    return query


def test_copies_late_rows_and_one_read(spark, paths):
    deliver(spark, paths["in"], ("a", minute(20)), ("a", minute(20)), ("b", minute(21)))
    deliver(spark, paths["in"], ("b", minute(21)), ("edge", minute(16)), ("in", minute(17)), ("c", minute(40)), start=3)
    deliver(spark, paths["in"], ("c", minute(40)), ("a", minute(20)), ("d", minute(36)), start=7)
    query = run(spark, paths)
    # 00:16 is the first watermark itself; copies of a and b are late or known.
    assert rows(spark, paths) == [("a", 0), ("b", 0), ("c", 1), ("d", 2), ("in", 1)]
    assert spark.read.parquet(paths["raw"]).count() == 10
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 4, 3]


def test_a_repeated_batch_replaces_its_folders(spark, paths):
    deliver(spark, paths["in"], ("a", minute(20)), ("b", minute(21)))
    stops = iter([True, False])

    def stop(number):
        if next(stops):
            raise InterruptedError("written, not committed")

    with pytest.raises(Exception, match="not committed"):
        run(spark, paths, written=stop)
    assert rows(spark, paths) == [("a", 0), ("b", 0)]
    run(spark, paths, written=stop)
    assert rows(spark, paths) == [("a", 0), ("b", 0)]
    assert spark.read.parquet(paths["raw"]).count() == 2


def test_batches_without_valid_rows(spark, paths):
    deliver(spark, paths["in"], ("x", "yesterday"))
    deliver(spark, paths["in"], ("a", minute(20)), start=1)
    deliver(spark, paths["in"], ("y", "tomorrow"), start=2)
    deliver(spark, paths["in"], ("a", minute(20)), start=3)
    run(spark, paths)
    assert rows(spark, paths) == [("a", 1)]
    assert read_batches(spark, paths["alerts"], PROCESSED).count() == 0
