"""Operators that split hot keys, against brute force on small skewed inputs."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshhaul.operators import merge, metrics, quality, sampling, windows

START = datetime(2024, 1, 31)


def series(spark, sizes, seed=1):
    """Rows per truck at random times, one truck far larger than the others."""
    rnd, rows = random.Random(seed), []
    for truck, size in sizes.items():
        for i in range(size):
            at = START + timedelta(seconds=rnd.randrange(30_000))
            rows.append((truck, f"{truck}-{i:05d}", at, float(rnd.randrange(1000)), float(i)))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(
        rows, "truck_id string, event_id string, event_time timestamp_ntz, x double, y double"
    ).repartition(5)


@pytest.mark.parametrize("block", [3, 7, 64, 4096])
def test_sequences_equal_brute_force(spark, block):
    n = 3
    rows, df = series(spark, {"hot": 400, "small": 9, "edge": 4, "short": 3, "one": 1})
    expected = set()
    for truck in {r[0] for r in rows}:
        run = sorted((r for r in rows if r[0] == truck), key=lambda r: (r[2], r[1]))
        for end in range(n - 1, len(run) - 1):
            steps = tuple(r[3] for r in run[end - n + 1 : end + 1])
            expected.add((truck, run[end][1], steps, run[end][4]))
    out = windows.sequences(df, "truck_id", ["event_time", "event_id"], ["x"], "y", n=n, block=block)
    got = {
        (r["truck_id"], r["event_id"], tuple(s["x"] for s in r["sequence"]), r["y"])
        for r in out.collect()
    }
    assert got == expected
    assert out.count() == len(expected)


def test_sequences_need_a_block_of_their_length(spark):
    _, df = series(spark, {"a": 5})
    with pytest.raises(ValueError, match="block"):
        windows.sequences(df, "truck_id", ["event_time"], ["x"], "y", n=10, block=5)


def test_rank_and_total(spark):
    rows, df = series(spark, {"hot": 300, "small": 5})
    out = windows.ranked(
        df, "truck_id", F.date_trunc("hour", "event_time"), [F.col("event_time"), F.col("event_id")]
    )
    got = {r["event_id"]: (r["_rank"], r["_total"]) for r in out.collect()}
    for truck in ("hot", "small"):
        run = sorted((r for r in rows if r[0] == truck), key=lambda r: (r[2], r[1]))
        assert [got[r[1]] for r in run] == [(i + 1, len(run)) for i in range(len(run))]


def test_latest_and_last_n(spark):
    rows, df = series(spark, {"hot": 200, "ten": 10, "nine": 9})
    runs = {
        t: sorted((r for r in rows if r[0] == t), key=lambda r: (r[2], r[1]))
        for t in ("hot", "ten", "nine")
    }
    latest = windows.latest_by(df, "truck_id", ["event_time", "event_id"])
    assert {r["truck_id"]: r["event_id"] for r in latest.collect()} == {
        t: run[-1][1] for t, run in runs.items()
    }
    last = windows.last_n(df, "truck_id", ["event_time", "event_id"], 10, ["event_id"])
    assert {r["truck_id"]: [s["event_id"] for s in r["readings"]] for r in last.collect()} == {
        t: [r[1] for r in runs[t][-10:]] for t in ("hot", "ten")
    }


def test_latest_cuts_rows_before_the_shuffle(spark):
    _, df = series(spark, {"a": 5})
    latest = windows.latest_by(df, "truck_id", ["event_time", "event_id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange hashpartitioning(truck_id")[1]
    assert "WindowGroupLimit" in before_exchange


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_median(spark, accuracy):
    rnd = random.Random(3)
    groups = {
        "hot": [rnd.gauss(0, 1) for _ in range(3001)],
        "even": [rnd.gauss(5, 1) for _ in range(1000)],
        "ties": [1.0] * 700 + [2.0] * 700,
        "one": [4.0],
        "two": [1.0, 2.0],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r["k"]: (r["median"], r["n"]) for r in quality.exact_median(df, "k", "v", accuracy).collect()}
    assert got == {k: (pytest.approx(statistics.median(v)), len(v)) for k, v in groups.items()}


def test_split_sizes_are_proportional_and_deterministic(spark):
    rows = [(f"e{i}", 0 if i % 10 < 6 else (1 if i % 10 < 9 else 2)) for i in range(1003)]
    df = spark.createDataFrame(rows, "event_id string, y int")
    split = sampling.stratified_split(df, "y", "event_id", 0.2, 42)
    sizes = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    whole = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    assert sum(n for (_, part), n in sizes.items() if part == "test") == 201
    for y, n in whole.items():
        assert sizes[y, "test"] + sizes[y, "train"] == n
        assert abs(sizes[y, "test"] - 0.2 * n) < 1
    again = sampling.stratified_split(df.repartition(9), "y", "event_id", 0.2, 42)
    assert split.exceptAll(again).count() == 0
    other = sampling.stratified_split(df, "y", "event_id", 0.2, 7)
    assert split.exceptAll(other).count() > 0


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", None)], "event_id string, y int")
    split = sampling.stratified_split(df, "y", "event_id")
    assert split.count() == 2
    assert split.filter("split = 'test'").count() == 1


def test_new_only_dedupes_and_keeps_null_ids(spark):
    rows = [("a", 3), ("a", 1), ("a", 2), ("b", 1), ("c", 1), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "event_id string, event_time int")
    known = spark.createDataFrame([("b",), ("b",), (None,)], "event_id string")
    got = sorted(map(tuple, merge.new_only(df, known).collect()), key=repr)
    assert got == sorted([("a", 1), ("c", 1), (None, 1), (None, 1)], key=repr)


def test_holdout_takes_the_last_keys(spark):
    df = spark.createDataFrame([(f"T{i % 7}",) for i in range(70)], "truck_id string")
    train, test = sampling.holdout_keys(df, "truck_id", 2)
    assert {r[0] for r in test.distinct().collect()} == {"T5", "T6"}
    assert train.count() == 50


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (2, 2)], "y int, p int")
    rows = {r["class"]: r for r in metrics.class_scores(df, "y", "p").collect()}
    assert (rows[0]["precision"], rows[0]["recall"], rows[0]["f1"]) == (0.0, 0.0, 0.0)
    assert (rows[1]["precision"], rows[1]["recall"]) == (0.0, 0.0)
    macro = metrics.macro_metrics(df, "y", "p").first()
    assert macro["accuracy"] == pytest.approx(1 / 3)
    assert macro["f1_macro"] == pytest.approx(1 / 3)


def test_quality_of_an_empty_frame(spark):
    df = spark.createDataFrame(
        [], "temperature double, humidity double, methane double, co2 double, food_name string"
    )
    rows = quality.quality(df).collect()
    assert {(r["null_count"], r["null_pct"], r["total_rows"]) for r in rows} == {(0, None, 0)}
    assert len(rows) == 6
