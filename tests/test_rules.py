"""Thresholds, nulls and unknown foods on literal rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freshhaul.functions import rules, scores
from freshhaul.operators import alerts, cleaning, featurize
from freshhaul.plans.readings import cleaned
from freshhaul.reference import FOODS, UNKNOWN_FOOD, food_ref

SENSOR_DDL = (
    "event_id string, food_name string, temperature double, humidity double, methane double,"
    " co2 double, storage_days double"
)


def one(spark, ddl, *row):
    return spark.createDataFrame([row], ddl)


def sensors(spark, *rows):
    return spark.createDataFrame(list(rows), SENSOR_DDL)


@pytest.mark.parametrize(
    ("risk", "expected"),
    [
        (0.65, (2, 0.80)), (0.6499, (1, 0.20)), (0.40, (1, 0.20)), (0.3999, (1, 0.15)),
        (0.20, (1, 0.15)), (0.1999, (0, 0.05)), (None, (0, 0.05)),
    ],
)
def test_rule_score_tiers(spark, risk, expected):
    df = featurize.rule_score(one(spark, "storage_risk_score double", risk))
    p = df.first()["prediction"]
    assert (p["cls"], p["p_spoiled"]) == expected


@pytest.mark.parametrize(
    ("risk", "level"),
    [(0.65, "CRITICAL"), (0.64, "WARNING"), (0.40, "WARNING"), (0.39, "WATCH"), (0.20, "WATCH"),
     (0.19, "SAFE"), (None, "SAFE")],
)
def test_four_levels(spark, risk, level):
    df = featurize.risk_tiers(one(spark, "storage_risk_score double", risk))
    assert df.first()["risk_level"] == level


@pytest.mark.parametrize(
    ("spoiled", "risk", "ch4", "co2", "rate", "label"),
    [
        (0, 0.9, 100.0, 2000.0, 1.0, 0),  # a valid given label wins
        (7, 0.9, 0.0, 400.0, 0.0, 2),  # an invalid one does not
        (None, 0.65, 0.0, 400.0, 0.0, 2),
        (None, 0.0, 80.0, 400.0, 0.0, 2),
        (None, 0.0, 0.0, 1200.0, 0.0, 2),
        (None, 0.35, 0.0, 400.0, 0.0, 1),
        (None, 0.0, 20.0, 400.0, 0.2, 0),  # both bounds are strict
        (None, 0.0, 20.01, 400.0, 0.0, 1),
        (None, 0.0, 0.0, 400.0, 0.21, 1),
    ],
)
def test_hour_label(spark, spoiled, risk, ch4, co2, rate, label):
    df = one(
        spark,
        "spoiled int, storage_risk_score double, methane_avg double, co2_avg double, breach_rate double",
        spoiled, risk, ch4, co2, rate,
    )
    assert featurize.label_hours(df).first()["spoilage_label"] == label


def test_breach_is_strict_and_food_specific(spark):
    rows = [(name, safe + d) for name, safe, *_ in FOODS for d in (0.0, 0.01)]
    rows += [("Durian", 6.0), ("Durian", 6.01), ("Durian", None)]
    df = featurize.breach_flag(spark.createDataFrame(rows, "food_name string, temperature double"))
    got = [r["temp_breach_flag"] for r in df.collect()]
    assert sorted(got) == [0] * (len(FOODS) + 2) + [1] * (len(FOODS) + 1)


def test_levels_to_class_and_back(spark):
    df = spark.createDataFrame([(l,) for l in ("CRITICAL", "WARNING", "WATCH", "SAFE")], "l string")
    assert [r[0] for r in df.select(rules.level_to_class(F.col("l"))).collect()] == [2, 1, 0, 0]
    df = spark.createDataFrame([(2,), (1,), (0,), (None,)], "c int")
    names = [r[0] for r in df.select(rules.three_level(F.col("c"))).collect()]
    assert names == ["CRITICAL", "WARNING", "SAFE", "SAFE"]


def scored_row(spark, p, cls, flag, message_part="Milk"):
    return one(
        spark,
        "truck_id string, food_name string, temperature double, prob_spoiled double,"
        " ml_predicted_class int, temp_breach_flag int, risk_level string",
        "TRK-001", message_part, 4.5, p, cls, flag, "CRITICAL",
    )


@pytest.mark.parametrize(
    ("p", "cls", "flag", "kind"),
    [
        (0.70, 1, 0, "ML_HIGH_RISK"), (0.9, 2, 1, "ML_SPOILED"), (0.1, 0, 1, "TEMP_BREACH"),
        (0.6999, 1, 0, None), (None, 2, 0, "ML_SPOILED"), (None, None, 1, "TEMP_BREACH"),
        (None, None, 0, None),
    ],
)
def test_alert_types(spark, p, cls, flag, kind):
    found = alerts.alerts(scored_row(spark, p, cls, flag)).collect()
    assert [r["alert_type"] for r in found] == ([kind] if kind else [])


def test_alert_message(spark):
    row = alerts.alerts(scored_row(spark, 0.8, 2, 1)).first()
    assert row["alert_message"] == (
        "ALERT: TRK-001 | Milk | Temp=4.5°C | ML_class=2 | Prob_Spoiled=0.8 | Level=CRITICAL"
    )
    assert alerts.alerts(scored_row(spark, 0.8, 2, 1, None)).first()["alert_message"] is None


@pytest.mark.parametrize(
    ("hours", "word"), [(11.99, "critical"), (12.0, "low"), (47.9, "low"), (48.0, "ok"), (None, None)]
)
def test_urgency(spark, hours, word):
    assert featurize.urgency(one(spark, "remaining_hours double", hours)).first()["urgency"] == word


def test_shelf_life_floor_and_unknown_food(spark):
    df = spark.createDataFrame(
        [("Fish", 0.5, 9.0), ("Durian", 0.5, 1.0), ("Milk", None, 1.0)],
        "food_name string, storage_risk_score double, storage_days double",
    )
    left = [r["remaining_hours"] for r in featurize.shelf_life(df).collect()]
    assert left == [0.0, 168 * 0.5 - 24, None]


def test_model_inputs_replace_zero_and_null(spark):
    from freshhaul.schemas import CORE_FEATURES

    df = sensors(spark, ("a", None, None, 0.0, None, 0.0, 3.0), ("b", "Milk", 2.0, 50.0, 1.0, 500.0, 0.0))
    df = df.withColumns({c: F.lit(None).cast("double") for c in CORE_FEATURES})
    a, b = featurize.fill_model_inputs(df).orderBy("event_id").collect()
    assert (a["temperature"], a["humidity"], a["co2"], a["food_key"]) == (0.0, 63.0, 400.0, "chicken")
    assert (b["temperature"], b["humidity"], b["co2"], b["food_key"]) == (2.0, 50.0, 500.0, "milk")


def test_imputation_by_profile(spark):
    empty = (None,) * 5
    df = sensors(spark, ("a", "Apple", *empty), ("b", "Durian", *empty), ("c", None, *empty))
    stream = {r["event_id"]: r for r in cleaning.impute(df, "stream").collect()}
    batch = {r["event_id"]: r for r in cleaning.impute(df, "batch").collect()}
    assert [stream[k]["temperature"] for k in "abc"] == [12.0, 11.0, 11.0]
    assert [batch[k]["temperature"] for k in "abc"] == [9.74, 11.0, 11.0]
    assert stream["a"]["methane"] == 38.0 and batch["a"]["methane"] == 44.25
    assert stream["a"].asDict().keys() == df.first().asDict().keys()


def test_imputation_takes_a_given_dimension(spark):
    dim = spark.createDataFrame([("Durian", 3.3)], "food_name string, stream_median_c double")
    df = sensors(spark, ("a", "Durian", None, 1.0, 1.0, 1.0, 1.0))
    assert cleaning.impute(df, "stream", dim).first()["temperature"] == 3.3


def test_clip_is_idempotent_and_bounded(spark):
    df = sensors(
        spark, ("a", "Milk", 99.0, 500.0, 999.0, 9e9, 99.0), ("b", "Milk", -99.0, 0.0, -1.0, 0.0, -1.0)
    )
    once = cleaning.clip_ranges(df)
    assert once.collect() == cleaning.clip_ranges(once).collect()
    high, low = once.orderBy("event_id").collect()
    assert tuple(high)[2:] == (35.0, 100.0, 180.0, 2400.0, 15.0)
    assert tuple(low)[2:] == (-5.0, 20.0, 0.0, 300.0, 0.0)


def test_validity(spark):
    ddl = "truck_id string, food_name string, event_time string, temperature double, humidity double, methane double, co2 double"
    rows = [
        ("T", "Milk", "t", None, None, 1.0, None),
        ("T", "Milk", "t", None, 50.0, None, None),  # humidity alone does not count
        (None, "Milk", "t", 1.0, 1.0, 1.0, 1.0),
        ("T", None, "t", 1.0, 1.0, 1.0, 1.0),
        ("T", "Milk", None, 1.0, 1.0, 1.0, 1.0),
    ]
    assert cleaning.valid_rows(spark.createDataFrame(rows, ddl)).count() == 1


def test_zero_co2_and_empty_hour(spark):
    df = one(spark, "a double, b double", 5.0, 0.0)
    assert df.select(scores.gas_ratio(F.col("a"), F.col("b"))).first()[0] == 0.0
    assert df.select(scores.share(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_features_do_not_depend_on_row_order_and_stay_in_range(readings):
    rated = featurize.core_features(cleaned(readings, "stream"))
    again = featurize.core_features(cleaned(readings.orderBy(F.desc("event_id")), "stream"))
    assert rated.exceptAll(again).count() == 0
    low, high = rated.agg(F.min("storage_risk_score"), F.max("storage_risk_score")).first()
    assert 0 <= low <= high <= 1


def test_one_hot_sums_to_one_or_zero(spark):
    df = spark.createDataFrame([("Milk",), ("Durian",), (None,)], "food_name string")
    hot = featurize.one_hot(df)
    flags = [c for c in hot.columns if c.startswith("food_") and c != "food_name"]
    assert [sum(r[c] for c in flags) for r in hot.collect()] == [1, 0, 0]
    assert len(flags) == 15


def test_what_if_guard_rails(spark):
    df = sensors(
        spark,
        ("calm", "Milk", 4.0, 60.0, 5.0, 450.0, 2.9),
        ("severe", "Milk", 13.01, 60.0, 0.0, 300.0, 0.0),
    )
    rows = {r["event_id"]: r for r in featurize.what_if(df).collect()}
    assert rows["calm"]["what_if_class"] == 0
    assert rows["severe"]["what_if_class"] == 2
    for r in rows.values():
        assert abs(r["p_fresh"] + r["p_at_risk"] + r["p_spoiled"] - 1) < 0.002


def test_food_table(spark):
    dim = food_ref(spark)
    assert dim.count() == 15
    assert set(UNKNOWN_FOOD) == set(dim.columns) - {"food_name"}


def test_severity_bands(spark):
    df = sensors(spark, ("a", "Milk", 15.0, 1.0, 80.0, 1400.0, 1.0), ("b", "Milk", 15.1, 1.0, 80.1, 1400.1, 1.0))
    df = df.withColumn("storage_risk_score", F.when(F.col("event_id") == "a", 0.65).otherwise(0.66))
    a, b = featurize.severity_bands(df).orderBy("event_id").collect()
    names = ["temp_band", "methane_band", "co2_band", "risk_band"]
    assert [a[n] for n in names] == ["raised"] * 4
    assert [b[n] for n in names] == ["high"] * 4
