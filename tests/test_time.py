"""Event times, look-back modes and partition columns."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from freshhaul.functions.times import moment
from freshhaul.operators import cleaning
from freshhaul.plans.features import feature_window
from freshhaul.sources.files import read_zone


def frame(spark, *times):
    rows = [(datetime.fromisoformat(t),) for t in times]
    return cleaning.with_partitions(spark.createDataFrame(rows, "event_time timestamp_ntz"))


def kept(df):
    return sorted(r["event_time"].isoformat(" ", "minutes") for r in df.collect())


MONTH_END = ("2024-01-30 10:00", "2024-01-31 12:00", "2024-01-31 23:00", "2024-02-01 01:00")


def test_modes_at_a_month_end(spark):
    df, now = frame(spark, *MONTH_END), datetime(2024, 2, 1, 12)
    assert kept(cleaning.lookback(df, now, 24)) == list(MONTH_END[1:])
    # Reference predicates: day 1 is below day 31, so February is lost.
    assert kept(cleaning.lookback(df, now, 24, "partition_ge")) == list(MONTH_END[1:3])
    assert kept(cleaning.lookback(df, now, 24, "partition_eq")) == list(MONTH_END[1:3])


def test_modes_at_a_year_end(spark):
    df, now = frame(spark, "2023-12-31 23:30", "2024-01-01 00:30"), datetime(2024, 1, 1, 1)
    assert len(kept(cleaning.lookback(df, now, 2))) == 2
    # Reference predicates: month 1 is below month 12, so the new year is lost.
    assert kept(cleaning.lookback(df, now, 2, "partition_ge")) == ["2023-12-31 23:30"]


def test_bound_is_inclusive(spark):
    df, now = frame(spark, "2024-01-31 12:00", "2024-01-31 11:59"), datetime(2024, 2, 1, 12)
    assert kept(cleaning.lookback(df, now, 24)) == ["2024-01-31 12:00"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="look-back"):
        cleaning.lookback(frame(spark, "2024-01-31 12:00"), datetime(2024, 2, 1), 1, "other")


def test_feature_window_starts_at_a_full_hour(spark):
    df = frame(spark, "2024-01-31 12:05", "2024-01-31 11:59")
    assert kept(feature_window(df, datetime(2024, 2, 1, 12, 40), 24)) == ["2024-01-31 12:05"]


def test_directories_are_pruned(spark, tmp_path):
    path = str(tmp_path / "zone")
    frame(spark, *MONTH_END).write.partitionBy("year", "month", "day").parquet(path)
    recent = cleaning.lookback(read_zone(spark, path), datetime(2024, 2, 1, 12), 11)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_time" in plan.split("PushedFilters: [")[1]
    assert kept(recent) == ["2024-02-01 01:00"]


def test_unreadable_time_is_null(spark):
    df = spark.createDataFrame(
        [("2024-01-31 12:00:05",), ("2024-13-31 12:00:05",), ("noon",), (None,)], "timestamp string"
    )
    got = [r["event_time"] for r in cleaning.with_event_time(df).collect()]
    assert got == [datetime(2024, 1, 31, 12, 0, 5), None, None, None]


def test_partition_columns_fall_back(spark):
    df = spark.createDataFrame([(None, None)], "event_time timestamp, kafka_timestamp timestamp")
    nothing = F.lit(None).cast("timestamp")
    row = cleaning.with_partitions(df, nothing).first()
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2026, 1, 1, 0)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_times_are_wall_clock_of_the_session(spark, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = spark.createDataFrame([("2024-01-31 12:00:00",), ("2024-01-31 11:59:59",)], "t string")
        df = cleaning.with_partitions(texts.select(F.col("t").cast(kind).alias("event_time")))
        recent = cleaning.lookback(df, datetime(2024, 2, 1, 12), 24)
        got = recent.select(F.col("event_time").cast("string"), "day", "hour").collect()
        assert [tuple(r) for r in got] == [("2024-01-31 12:00:00", 31, 12)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_aware_times_are_refused():
    with pytest.raises(ValueError, match="wall clock"):
        moment(datetime(2024, 1, 1, tzinfo=timezone.utc))
