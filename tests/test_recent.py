"""Last readings per truck, late rows and medians of large keys."""

from __future__ import annotations

import random
import statistics

import pytest
from test_streaming import ONCE, deliver, ids, message, paths_in

from freshhaul.catalog import fixtures as fx
from freshhaul.catalog.queries import _alert_table
from freshhaul.operators.enrich import settled
from freshhaul.operators.quality import exact_median
from freshhaul.operators.recent import full_rings, merge_recent, newest, recent_readings, unpacked
from freshhaul.plans.recovery import late_rows, read_processed, recover
from freshhaul.plans.serving import serving_views, truck_views, write_views
from freshhaul.sinks.tables import read_snapshot
from freshhaul.sources.kafka import read_envelope_files
from freshhaul.streaming import pipeline


def as_dict(table):
    return {r.truck_id: [x.event_id for x in r.readings] for r in table.collect()}


def test_merging_batches_equals_the_whole(readings):
    rows = fx.processed(readings).persist()
    whole = as_dict(recent_readings(rows))
    table = recent_readings(rows.filter("false"))
    for part in (2, 0, 1, 1):  # out of order, and one batch twice
        table = settled(merge_recent(table, rows.filter(fx.number() % 3 == part)))
    assert as_dict(table) == whole
    assert all(len(v) <= 10 for v in whole.values())
    last = {r.truck_id: r.event_id for r in newest(table).collect()}
    assert last == {k: v[-1] for k, v in whole.items()}
    assert unpacked(table).count() == sum(map(len, whole.values()))
    rows.unpersist()


def test_the_stream_keeps_the_table(spark, tmp_path):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path) | {"recent": str(tmp_path / "recent")}
    times = [f"2024-01-31 10:{i:02d}:00" for i in range(12)]
    deliver(spark, source, [message(f"e{i:02d}", t) for i, t in enumerate(times[:7])])
    deliver(spark, source, [message(f"e{i:02d}", t) for i, t in enumerate(times) if i >= 5], 7)
    deliver(spark, source, [message("x1", "2024-01-31 10:11:30", truck_id="TRK-002")], 20)
    stream = read_envelope_files(spark, source, max_files=1)
    started = pipeline.stream_pipeline(stream, paths, trigger=ONCE)
    for query in started.values():
        query.awaitTermination()
    table = read_snapshot(spark, paths["recent"], "recent_readings")
    assert as_dict(table) == {"TRK-001": [f"e{i:02d}" for i in range(2, 12)], "TRK-002": ["x1"]}
    assert [r.truck_id for r in full_rings(table).collect()] == ["TRK-001"]


def test_views_are_written(spark, readings, tmp_path):
    fleet, history = fx.fleet(readings), fx.processed(readings)
    recent = recent_readings(history)
    views = serving_views(
        fleet, history, _alert_table(readings), fx.model_metrics(readings), fx.NOW, "TRK-001", recent=recent
    )
    some = {k: views[k] for k in truck_views(recent)}
    paths = write_views(some, str(tmp_path))
    n = fleet.count()
    for name in ("latest", "shelf_life", "what_if", "severity_bands"):
        assert spark.read.parquet(paths[name]).count() == n
    assert spark.read.parquet(paths["contributions"]).count() == 3 * n


def test_late_rows_come_back_once(spark, tmp_path):
    source, paths = str(tmp_path / "in"), paths_in(tmp_path)
    deliver(spark, source, [message("a", "2024-01-31 10:00:00")])
    deliver(spark, source, [message("b", "2024-01-31 11:00:00")], 1)
    deliver(spark, source, [message("late", "2024-01-31 09:00:00"), message("c", "2024-01-31 11:01:00")], 2)
    stream = read_envelope_files(spark, source, max_files=1)
    started = pipeline.stream_pipeline(stream, paths, trigger=ONCE)
    for query in started.values():
        query.awaitTermination()
    assert ids(spark, paths["processed"]) == ["a", "b", "c"]
    assert late_rows(started["processed"]) == 1
    late = str(tmp_path / "late")
    assert recover(spark, paths["raw"], paths["processed"], late) == 1
    assert recover(spark, paths["raw"], paths["processed"], late) == 0
    whole = read_processed(spark, paths["processed"], late)
    assert sorted(r.event_id for r in whole.collect()) == ["a", "b", "c", "late"]


@pytest.mark.parametrize("bound", [1, 50, 100_000])
def test_median_of_any_spread(spark, bound):
    rng = random.Random(bound)
    values = {
        "even": [rng.uniform(-1, 1) for _ in range(2000)],
        "odd": [rng.gauss(0, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(1001)],
        "ties": [float(rng.randrange(3)) for _ in range(1000)],
        "near": [1.0 + rng.randrange(10**6) * 2.0**-52 for _ in range(2000)],
        "one": [-0.0], "two": [-5.0, 7.0], "signs": [-1.5, -2.5, 0.0, 3.0], "huge": [1e308, -1e308, 1.7e308],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("even", None), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.median, r.n) for r in exact_median(df, "k", "v", bound).collect()}
    want = {}
    for k, vs in values.items():
        s = sorted(vs)
        a, z = s[(len(s) - 1) // 2], s[len(s) // 2]
        want[k] = (a * 0.5 + z * 0.5, len(s))
    assert got == want
    assert statistics.median(values["ties"]) == got["ties"][0]
