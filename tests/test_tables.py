"""Sources, sinks, keyed tables and the batch jobs."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshhaul import storage
from freshhaul.catalog import fixtures as fx
from freshhaul.functions.times import moment
from freshhaul.operators import cleaning, merge, quality
from freshhaul.plans import features as feature_plan
from freshhaul.plans import report, serving, sync
from freshhaul.schemas import (
    ALERT_ZONE,
    ALERTS,
    FEATURE_COLUMNS,
    FLEET_STATUS,
    PROCESSED,
    TABLE_KEYS,
    conform,
    duplicate_keys,
)
from freshhaul.session import scratch_of_job, scratch_path
from freshhaul.sinks import files as file_sinks
from freshhaul.sinks import jdbc as jdbc_sinks
from freshhaul.sinks import tables
from freshhaul.sources import files as file_sources
from freshhaul.sources import jdbc as jdbc_sources
from freshhaul.sources import kafka

NOW = fx.NOW
FLEET = "truck_id string, food_name string, event_time timestamp, updated_at timestamp"


def at(hour):
    return datetime(2024, 1, 31, hour)


# --- contracts -------------------------------------------------------------------


def test_contract_sizes():
    assert len(PROCESSED) == 28
    assert len(ALERT_ZONE) == len(PROCESSED) + 2
    assert len(FEATURE_COLUMNS) == 49
    assert len(TABLE_KEYS["alerts"][0]) == 15


def test_features_have_the_contract_schema(readings):
    df = fx.features(readings)
    assert df.columns == FEATURE_COLUMNS
    kinds = dict(df.dtypes)
    assert kinds["readings_count"] == "bigint" and kinds["spoilage_label"] == "int"


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="truck_id"):
        conform(spark.range(1), FLEET_STATUS)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(r) for r in duplicate_keys(df, "k").collect()] == [("a", 2)]


# --- upsert and retention -----------------------------------------------------------


def test_upsert_cases(spark):
    target = spark.createDataFrame(
        [("keep", "old", at(1), at(9)), ("change", "old", at(1), at(9)), ("untouched", "old", at(1), at(9)),
         ("null", "old", None, at(9))],
        FLEET,
    )
    updates = spark.createDataFrame(
        [("keep", "new", at(1)), ("change", "new", at(2)), ("insert", "new", at(2)), ("null", "new", None)],
        "truck_id string, food_name string, event_time timestamp",
    )
    merged = merge.upsert(target, updates, "truck_id", "event_time", at(12))
    got = {r["truck_id"]: (r["food_name"], r["updated_at"]) for r in merged.collect()}
    assert got == {
        "keep": ("old", at(9)), "change": ("new", at(12)), "untouched": ("old", at(9)),
        "insert": ("new", at(12)), "null": ("old", at(9)),
    }
    again = merge.upsert(merged, updates, "truck_id", "event_time", at(13))
    assert sorted(again.collect()) == sorted(merged.collect())


def test_snapshots_survive_a_broken_write(spark, tmp_path):
    path = str(tmp_path / "fleet")
    tables.ensure_table(spark, path, "fleet_status")
    tables.ensure_table(spark, path, "fleet_status")
    assert tables.read_snapshot(spark, path, "fleet_status").count() == 0
    row = spark.createDataFrame([("T1",)], "truck_id string")
    full = row.select(*[
        (F.col("truck_id") if f.name == "truck_id" else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in FLEET_STATUS.fields
    ])
    assert tables.write_snapshot(full, path) == 2
    os.makedirs(f"{path}/snapshot=3")  # a writer died before _SUCCESS
    assert [r["truck_id"] for r in tables.read_snapshot(spark, path, "fleet_status").collect()] == ["T1"]
    assert tables.write_snapshot(full.unionAll(full), path) == 3
    assert tables.read_snapshot(spark, path, "fleet_status").count() == 2
    assert sorted(n for n in os.listdir(path)) == ["snapshot=2", "snapshot=3"]


def test_history_retention(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = [(f"e{d}{h}", "T1", datetime(2024, 1, d, h)) for d in (27, 29, 30, 31) for h in (1, 23)]
    df = spark.createDataFrame(rows, "event_id string, truck_id string, event_time timestamp")
    for name in ("temperature", "humidity", "methane", "co2"):
        df = df.withColumn(name, F.lit(1.0))
    tables.append_rows(df, path, "event_time")
    now = datetime(2024, 1, 31, 12)
    seen = {r["event_id"] for r in tables.read_history(spark, path, now, 48).collect()}
    assert seen == {"e2923", "e301", "e3023", "e311", "e3123"}
    assert tables.drop_expired_days(spark, path, now, 48) == ["year=2024/month=1/day=27"]
    assert {r["event_id"] for r in tables.read_history(spark, path, now, 48).collect()} == seen
    # On disk the day of the bound still has its first hours, until it is rewritten.
    assert spark.read.parquet(path).count() == 6
    assert tables.drop_expired_rows(spark, path, now, 48)
    assert not tables.drop_expired_rows(spark, path, now, 48)
    assert {r["event_id"] for r in spark.read.parquet(path).collect()} == seen
    assert tables.drop_expired_rows(spark, path, datetime(2024, 1, 31, 23, 30), 48)
    assert not os.path.exists(f"{path}/year=2024/month=1/day=29")
    assert not tables.drop_expired_rows(spark, path, datetime(2025, 1, 1), 48)


def test_prune_bound_is_strict(spark):
    df = spark.createDataFrame([(at(10),), (at(9),), (None,)], "event_time timestamp")
    assert merge.prune(df, at(12), 2).count() == 2


# --- sources ----------------------------------------------------------------------------


def test_absent_and_empty_zones(spark, tmp_path):
    assert file_sources.read_zone_or_none(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    assert file_sources.read_zone_or_none(spark, str(tmp_path / "empty")) is None


def test_or_else(spark):
    empty, full = spark.range(0), spark.range(3)
    assert file_sources.or_else(None, full).count() == 3
    assert file_sources.or_else(empty, full).count() == 3
    assert file_sources.or_else(full, empty).count() == 3


def test_csv_with_canonical_names(spark, tmp_path):
    header = (
        "event_id,truck_id,timestamp,gps_lat,gps_lon,Food_Name,Temperature,Humidity,Methane,CO2,"
        "Storage_Days,temp_humidity_index,gas_spoilage_score,methane_co2_ratio,temp_deviation,"
        "storage_risk_score,Spoiled,source"
    )
    line = "EVT-1,TRK-001,2024-01-31 07:08:09,1.0,2.0,Milk,5.5,,10,500,1.5,0,0,0,0,0,2,sensor"
    (tmp_path / "r.csv").write_text(f"{header}\n{line}\n")
    row = file_sources.read_readings_csv(spark, str(tmp_path / "r.csv")).first()
    assert row["food_name"] == "Milk" and row["humidity"] is None and row["spoiled"] == 2
    assert row["event_time"] == datetime(2024, 1, 31, 7, 8, 9) and row["hour"] == 7
    demo = file_sources.read_readings_csv(spark, str(tmp_path / "r.csv"), stamp_now=True).first()
    assert demo["year"] >= 2024 and demo["event_time"] != row["event_time"]


def test_kafka_options():
    options = kafka.kafka_options("b:9092", "sensor-raw")
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in options and options["subscribe"] == "sensor-raw"
    chosen = kafka.kafka_options("b", "t", "earliest", max_per_trigger=5000, fail_on_data_loss=False)
    assert chosen["maxOffsetsPerTrigger"] == "5000" and chosen["startingOffsets"] == "earliest"
    assert chosen["failOnDataLoss"] == "false"


def test_messages_parse_once(spark):
    df = spark.createDataFrame(
        [('{"event_id":"a","truck_id":"T","temperature":"warm","food_name":"Milk"}',), ("{oops",), (None,)],
        "json_str string",
    ).withColumns({"kafka_timestamp": F.lit(None).cast("timestamp"), "kafka_partition": F.lit(0), "kafka_offset": F.lit(0)})
    parsed = kafka.parse_readings(df)
    rows = parsed.collect()
    assert [r["event_id"] for r in rows] == ["a", None, None]
    assert rows[0]["temperature"] is None and rows[0]["food_name"] == "Milk"
    valid = cleaning.valid_rows(cleaning.with_event_time(parsed))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


class _Recorder:
    """Stands in for a reader or writer; keeps what it was asked to do."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    write = read

    def jdbc(self, **arguments):
        self.calls.append(arguments)
        return "frame"


def test_jdbc_requests():
    session = _Recorder()
    assert jdbc_sources.read_known_ids(session, "jdbc:x", "alerts", {}) == "frame"
    assert session.calls[0]["table"] == (
        "(SELECT DISTINCT event_id FROM alerts WHERE event_id IS NOT NULL) ids"
    )
    asked = session.calls[0]["predicates"]
    assert len(set(asked)) == 16 and asked[3].endswith("16) = 3") and "event_id" in asked[3]
    assert jdbc_sources.read_known_ids(session, "jdbc:x", "alerts", {}, "truck_id", 2) == "frame"
    assert [p.rsplit(", ", 1)[1] for p in session.calls[1]["predicates"]] == ["2) = 0", "2) = 1"]
    frame = _Recorder()
    jdbc_sinks.append_jdbc(frame, "jdbc:x", "t", {})
    jdbc_sinks.stage_jdbc(frame, "jdbc:x", "t", {})
    assert [c["mode"] for c in frame.calls] == ["append", "overwrite"]
    statement = jdbc_sinks.merge_statement("fleet", "staging", ["truck_id", "co2"], "truck_id", "event_time")
    assert "ON CONFLICT (truck_id) DO UPDATE SET co2 = EXCLUDED.co2" in statement
    assert statement.endswith("WHERE fleet.event_time IS DISTINCT FROM EXCLUDED.event_time")


# --- jobs -------------------------------------------------------------------------------------


@pytest.fixture
def zone(readings, tmp_path):
    df = fx.processed(readings).withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = str(tmp_path / "processed")
    df.write.partitionBy("year", "month", "day").parquet(path)
    return path


def test_features_replace_only_their_hours(spark, readings, tmp_path):
    path = str(tmp_path / "features")
    whole = fx.features(readings)
    file_sinks.write_features(whole, path)
    before = spark.read.parquet(path).count()
    part = whole.filter((F.col("day") == 31) & (F.col("hour") == 5)).limit(3)
    file_sinks.write_features(part, path)
    replaced = whole.filter((F.col("day") == 31) & (F.col("hour") == 5)).count()
    assert spark.read.parquet(path).count() == before - replaced + 3


def test_report_is_one_file_with_header(spark, tmp_path):
    file_sinks.write_report(spark.range(5).repartition(3), str(tmp_path / "report"))
    parts = list((tmp_path / "report").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text().startswith("id\n")


def test_feature_build(spark, zone, readings, tmp_path):
    paths = [str(tmp_path / n) for n in ("features", "reports", "runs")]
    out = feature_plan.feature_build(spark, zone, *paths[:2], NOW, hours=36, runs_path=paths[2])
    assert out["input_rows"] == readings.count()
    written = spark.read.parquet(paths[0])
    assert out["output_rows"] == written.count()
    assert out["quality"]["temperature"] == 0  # the processed zone is imputed
    assert len(out["riskiest_foods"]) == 5
    names = sorted(os.listdir(f"{paths[1]}/batch_report_{out['run_id']}"))
    assert names == ["food_risk_summary", "label_distribution", "risk_distribution"]
    run = tables.read_log(spark, paths[2], "pipeline_runs").first()
    assert (run["status"], run["rows_processed"]) == ("success", out["output_rows"])
    assert file_sinks.verify_features(spark, paths[0]).count() >= 2


def test_feature_build_profiles_the_input(spark, readings, tmp_path):
    raw = str(tmp_path / "raw")
    cleaning.with_partitions(fx.dirty(readings)).write.partitionBy("year", "month", "day").parquet(raw)
    out = feature_plan.feature_build(spark, raw, str(tmp_path / "f"), str(tmp_path / "r"), NOW, hours=36)
    expected = {n: fx.dirty(readings).filter(F.col(n).isNull()).count() for n in quality.PROFILED}
    assert out["quality"] == expected and all(expected.values())


def test_feature_build_falls_back_or_stops(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("zone", "features", "reports")]
    assert feature_plan.feature_build(spark, *paths, NOW)["input_rows"] == 0
    header = (
        "event_id,truck_id,timestamp,gps_lat,gps_lon,Food_Name,Temperature,Humidity,Methane,CO2,"
        "Storage_Days,temp_humidity_index,gas_spoilage_score,methane_co2_ratio,temp_deviation,"
        "storage_risk_score,Spoiled,source\n"
    )
    csv = tmp_path / "demo.csv"
    csv.write_text(header + "E,T,2024-01-31 07:08:09,1,2,Milk,5.5,,10,500,1.5,0,0,0,0,0,2,s\n" * 3)
    out = feature_plan.feature_build(spark, *paths, NOW, fallback_csv=str(csv))
    assert (out["input_rows"], out["output_rows"], out["quality"]["humidity"]) == (3, 1, 3)


def test_sync_alerts_twice_inserts_nothing(spark, readings, tmp_path):
    zone, table = str(tmp_path / "alerts"), str(tmp_path / "table")
    assert sync.sync_alerts(spark, zone, table, NOW) == 0
    df = fx.alert_zone(readings).withColumn("event_time", F.col("event_time").cast("timestamp"))
    df.unionAll(df).write.partitionBy("year", "month", "day").parquet(zone)
    recent = df.filter(F.col("event_time") >= NOW - timedelta(hours=4)).count()
    assert sync.sync_alerts(spark, zone, table, NOW, hours=4) == recent > 0
    assert sync.sync_alerts(spark, zone, table, NOW, hours=4) == 0
    stored = tables.read_log(spark, table, "alerts")
    assert stored.count() == recent
    assert set(ALERTS.fieldNames()) <= set(stored.columns)


def test_sync_fleet_is_idempotent(spark, zone, tmp_path):
    fleet, history = str(tmp_path / "fleet"), str(tmp_path / "history")
    first = sync.sync_fleet(spark, zone, fleet, history, NOW, hours=30)
    assert first["history_rows"] > 0
    state = tables.read_snapshot(spark, fleet, "fleet_status").orderBy("truck_id").collect()
    later = sync.sync_fleet(spark, zone, fleet, history, NOW + timedelta(minutes=15), hours=30.25)
    assert later["history_rows"] == 0
    assert tables.read_snapshot(spark, fleet, "fleet_status").orderBy("truck_id").collect() == state
    assert duplicate_keys(tables.read_log(spark, history, "sensor_history"), "event_id").isEmpty()
    assert sync.sync_fleet(spark, str(tmp_path / "none"), fleet, history, NOW)["history_rows"] == 0


def test_daily_report(spark, readings, tmp_path):
    features, runs = str(tmp_path / "features"), str(tmp_path / "runs")
    assert report.daily_report(spark, features, runs, NOW)["status"] == "failed"
    file_sinks.write_features(fx.features(readings), features)
    out = report.daily_report(spark, features, runs, NOW)
    assert out["status"] == "success"
    assert out["rows"] == sum(out["labels"].values()) == sum(out["risks"].values())
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not a table")
    assert report.daily_report(spark, str(broken), runs, NOW)["status"] == "failed"
    log = tables.read_log(spark, runs, "pipeline_runs").orderBy("status").collect()
    assert [(r["status"], r["rows_processed"]) for r in log] == [
        ("failed", 0), ("failed", 0), ("success", out["rows"])
    ]


def test_failed_and_empty_builds_are_logged(spark, tmp_path):
    broken, runs = tmp_path / "zone", str(tmp_path / "runs")
    args = (str(broken), str(tmp_path / "features"), str(tmp_path / "reports"), NOW)
    assert feature_plan.feature_build(spark, *args, runs_path=runs)["output_rows"] == 0
    log = tables.read_log(spark, runs, "pipeline_runs").collect()
    assert [(r["status"], r["rows_processed"]) for r in log] == [("success", 0)]


def test_scratch_of_a_job_is_removed(spark):
    with pytest.raises(KeyError), scratch_of_job(spark):
        path = scratch_path(spark, "left")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
        raise KeyError
    assert not storage.exists(spark, path)


def test_upsert_without_key_and_with_several(spark):
    target = spark.createDataFrame([("a", "Milk", at(1), at(1))], FLEET)
    rows = [("a", "Fish", at(2), None), ("a", "Eggs", at(3), None), (None, "Lost", at(4), None)]
    updates = spark.createDataFrame(rows, FLEET)
    for _ in range(2):
        target = merge.upsert(target, updates, "truck_id", "event_time", at(9))
        assert [(r["truck_id"], r["food_name"]) for r in target.collect()] == [("a", "Eggs")]


def test_serving_views(spark, readings):
    alert_table = fx.alert_zone(readings).withColumns(
        {"created_at": F.col("event_time"), "spoilage_prob": F.col("storage_risk_score")}
    )
    views = serving.serving_views(
        fx.fleet(readings), readings, alert_table, fx.model_metrics(readings), NOW, "TRK-007"
    )
    counts = {name: df.count() for name, df in views.items()}
    assert counts["fleet"] == counts["model_metrics"] == 15
    recent = alert_table.filter(F.col("created_at") >= moment(NOW - timedelta(hours=24), "timestamp_ntz"))
    assert counts["alerts"] == 40
    assert views["alert_counts"].first()["total"] == serving.drop_seed_rows(recent).count() > 40
    exotic = fx.fleet(readings).withColumn("food_name", F.lit("Durian"))
    view = serving.serving_views(exotic, readings, alert_table, fx.model_metrics(readings), NOW, "TRK-007")
    assert view["fleet"].count() == 15
    none = serving.serving_views(
        exotic, readings, alert_table, fx.model_metrics(readings), NOW, "TRK-007", foods=[]
    )
    assert none["fleet"].count() == 0
    assert counts["kpis"] == counts["fleet_freshness"] == counts["alert_freshness"] == 1
    assert views["temperature_histogram"].agg(F.sum("row_count")).first()[0] == 15


def test_jdbc_sync_requests(spark, zone, readings, tmp_path, monkeypatch):
    """What the database jobs ask for; no database is involved."""
    from freshhaul.plans import sync_jdbc

    stored = readings.select("event_id").filter(fx.number() % 3 == 0)
    sent, ran = {}, []
    monkeypatch.setattr(sync_jdbc, "read_known_ids", lambda *a: stored)
    monkeypatch.setattr(sync_jdbc, "append_jdbc", lambda df, url, table, props: sent.update({table: df.collect()}))
    monkeypatch.setattr(sync_jdbc, "stage_jdbc", lambda df, url, table, props: sent.update({table: df.collect()}))
    monkeypatch.setattr(sync_jdbc, "execute", lambda s, url, statements, props: ran.extend(statements))
    sync_jdbc.sync_fleet_jdbc(spark, zone, "jdbc:x", "fleet", "history", {}, NOW, hours=37)
    assert len(sent["fleet_staging"]) == 15
    assert len(sent["history"]) == readings.filter(fx.number() % 3 != 0).count()
    assert [s.split()[0] for s in ran] == ["INSERT", "DROP", "DELETE"]
    alert_zone = str(tmp_path / "alerts")
    df = fx.alert_zone(readings).withColumn("event_time", F.col("event_time").cast("timestamp"))
    df.write.partitionBy("year", "month", "day").parquet(alert_zone)
    sync_jdbc.sync_alerts_jdbc(spark, alert_zone, "jdbc:x", "alerts", {}, NOW, hours=37)
    assert len(sent["alerts"]) == df.filter(fx.number() % 3 != 0).count() > 0


def test_command_line(spark, zone, tmp_path, monkeypatch, capsys):
    import run_job

    monkeypatch.setattr(spark, "stop", lambda: None)
    monkeypatch.setattr(run_job, "build_session", lambda app: spark)
    folder = {n: str(tmp_path / n) for n in ("features", "reports", "runs", "fleet", "history")}

    def run(*words):
        monkeypatch.setattr("sys.argv", ["run_job.py", "--now", "2024-02-01T12:00:00", *words])
        run_job.main()
        return capsys.readouterr().out

    out = run("features", "--processed", zone, "--features", folder["features"], "--reports",
              folder["reports"], "--hours", "36", "--runs", folder["runs"])
    assert "'input_rows': 1000" in out
    assert "'status': 'success'" in run("report", "--features", folder["features"], "--runs", folder["runs"])
    assert "history_rows" in run("fleet", "--processed", zone, "--fleet", folder["fleet"],
                                 "--history", folder["history"], "--hours", "30")
    assert "'inserted': 0" in run("alerts", "--alerts", folder["history"] + "/none", "--table", folder["runs"])


def test_jobs_with_an_empty_window(spark, zone, readings, tmp_path):
    """The zones exist but hold nothing recent: clean no-ops."""
    later = NOW + timedelta(days=30)
    folder = {n: str(tmp_path / n) for n in ("features", "reports", "fleet", "history", "alerts", "table")}
    out = feature_plan.feature_build(spark, zone, folder["features"], folder["reports"], later)
    assert (out["input_rows"], out["output_rows"]) == (0, 0)
    assert sync.sync_fleet(spark, zone, folder["fleet"], folder["history"], later)["history_rows"] == 0
    df = fx.alert_zone(readings).withColumn("event_time", F.col("event_time").cast("timestamp"))
    df.write.partitionBy("year", "month", "day").parquet(folder["alerts"])
    assert sync.sync_alerts(spark, folder["alerts"], folder["table"], later) == 0
