"""Training, scoring, importance and the promotion gate."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from freshhaul.catalog import fixtures as fx
from freshhaul.models import classifier, shelf_life
from freshhaul.operators import gate, metrics, sampling
from freshhaul.plans.training import CLASSIFIER, train_and_gate
from freshhaul.sinks import tables

FOREST = {"numTrees": 10, "maxDepth": 6}


@pytest.fixture(scope="module")
def rated(readings):
    # A label that follows the score, so that there is something to learn.
    cls = F.when(F.col("storage_risk_score") >= 0.6, 2).when(F.col("storage_risk_score") >= 0.4, 1)
    return fx.rated(readings).withColumn("spoiled", cls.otherwise(0)).persist()


@pytest.fixture(scope="module")
def model(rated):
    return classifier.train_classifier(rated, **FOREST)


def test_scores(rated, model):
    scored = classifier.score(rated, model).persist()
    assert scored.count() == rated.count()
    assert set(rated.columns) < set(scored.columns)
    total = scored.agg(F.max(F.abs(F.col("p_fresh") + F.col("p_at_risk") + F.col("p_spoiled") - 1)))
    assert total.first()[0] < 0.001
    quality = metrics.macro_metrics(scored, "spoiled", "predicted_class").first()
    assert quality["f1_macro"] > 0.8


def test_unknown_food_has_no_flag(spark, rated):
    row = classifier.with_inputs(rated.withColumn("food_name", F.lit("Durian"))).first()
    assert sum(row[c] for c in classifier.ONE_HOT_COLUMNS) == 0


def test_importance(spark, rated, model):
    split = {r["feature"]: r["importance"] for r in classifier.split_importance(spark, model).collect()}
    assert sum(split.values()) == pytest.approx(1.0)
    swapped = {
        r["feature"]: r["accuracy_loss"]
        for r in classifier.permutation_importance(rated, model).collect()
    }
    assert set(swapped) == set(split) == set(classifier.INPUTS)
    assert max(swapped, key=swapped.get) in ("storage_risk_score", "temp_deviation", "temperature")


def test_boosting_stops_on_held_out_trucks(rated):
    trucks = [r[0] for r in rated.select("truck_id").distinct().orderBy("truck_id").collect()]
    held = F.col("truck_id").isin(trucks[-3:])
    # What holds for the other trucks does not hold for these, so more trees don't help them.
    odd = rated.withColumn(shelf_life.TARGET, F.when(held, 50.0).otherwise(F.col(shelf_life.TARGET)))
    small = {"maxDepth": 3, "maxIter": 12}
    stopped = shelf_life.train_shelf_life(odd, stop_trucks=3, **small)
    assert 1 <= stopped.getNumTrees < 12
    assert shelf_life.train_shelf_life(odd, **small).getNumTrees == 12

    # The held-out trucks give no tree: any target of theirs leaves the first tree as it is.
    other = odd.withColumn(shelf_life.TARGET, F.when(held, 51.0).otherwise(F.col(shelf_life.TARGET)))
    again = shelf_life.train_shelf_life(other, stop_trucks=3, **small)
    assert again.trees[0].toDebugString.split("\n")[1:] == stopped.trees[0].toDebugString.split("\n")[1:]

    one = rated.filter(F.col("truck_id") == trucks[0])
    assert shelf_life.train_shelf_life(one, stop_trucks=3, **small).getNumTrees == 12


def test_shelf_life_model_beats_the_mean(rated):
    model = shelf_life.train_shelf_life(rated, maxIter=5, maxDepth=4)
    guesses = shelf_life.predict_sequences(shelf_life.training_sequences(rated), model).persist()
    fitted = metrics.regression_metrics(guesses, shelf_life.TARGET, "predicted_hours").first()
    mean = guesses.agg(F.avg(shelf_life.TARGET)).first()[0]
    naive = metrics.regression_metrics(
        guesses.withColumn("m", F.lit(mean)), shelf_life.TARGET, "m"
    ).first()
    assert fitted["mae"] < 0.7 * naive["mae"]
    assert guesses.agg(F.min("predicted_hours")).first()[0] >= 0
    latest = shelf_life.predict_latest(rated, model)
    assert latest.count() == rated.select("truck_id").distinct().count()


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = metrics.fit_scaler(df, ["a", "b"])
    assert stats.first()["a_std"] == 1.0  # population deviation
    scaled = sorted(map(tuple, metrics.apply_scaler(df, stats, ["a", "b"]).collect()))
    assert scaled == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize(
    ("versions", "decision", "stages"),
    [
        # (version, stage, metric); higher is better
        ([(1, "None", 0.5)], "promote", {1: "Production"}),
        ([(1, "Production", 0.5), (2, "None", 0.6)], "promote", {1: "Archived", 2: "Production"}),
        ([(1, "Production", 0.5), (2, "None", 0.5)], "promote", {1: "Archived", 2: "Production"}),
        ([(1, "Production", 0.5), (2, "None", 0.4)], "keep", {1: "Production", 2: "None"}),
        ([(1, "Production", 0.5), (2, "None", None)], "skip", {1: "Production", 2: "None"}),
        ([(1, "Production", None), (2, "None", 0.1)], "promote", {1: "Archived", 2: "Production"}),
        ([(1, "None", 0.1), (2, "Production", 0.5)], "none", {1: "None", 2: "Production"}),
    ],
)
def test_gate(spark, versions, decision, stages):
    rows = [("m", v, f"r{v}", s, x, "higher_is_better") for v, s, x in versions]
    registry = spark.createDataFrame(
        rows, "model string, version int, run_id string, stage string, metric double, direction string"
    )
    out = gate.promote(registry).collect()
    assert {r["decision"] for r in out} == {decision}
    assert {r["version"]: r["new_stage"] for r in out} == stages


def test_gate_for_errors(spark):
    rows = [("m", 1, "r1", "Production", 5.0, "lower_is_better"), ("m", 2, "r2", "None", 4.0, "lower_is_better")]
    registry = spark.createDataFrame(
        rows, "model string, version int, run_id string, stage string, metric double, direction string"
    )
    assert {r["decision"] for r in gate.promote(registry).collect()} == {"promote"}


def test_train_and_gate(spark, readings, tmp_path):
    out, now = str(tmp_path), datetime(2024, 2, 1)
    options = {"forest": {"numTrees": 3, "maxDepth": 3}, "boosting": {"maxIter": 2, "maxDepth": 2}, "holdout": 3}
    first = train_and_gate(spark, readings, out, now, **options)
    assert first[CLASSIFIER] == {"version": 1, "decision": "promote"}
    assert 0 <= first["classifier"]["accuracy"] <= 1 and first["regressor"]["mae"] > 0
    second = train_and_gate(spark, readings, out, now + timedelta(days=1), **options)
    assert second[CLASSIFIER]["version"] == 2
    registry = tables.read_snapshot(spark, f"{out}/registry", "registry")
    live = registry.filter("stage = 'Production'").groupBy("model").count().collect()
    assert sorted(r["count"] for r in live) == [1, 1] and registry.count() == 4
    log = tables.read_log(spark, f"{out}/model_metrics", "model_metrics")
    assert log.count() == 2 and log.filter("f1_score IS NULL").count() == 0


def _partitions_of_fit(monkeypatch, estimator):
    """Row counts of the partitions that an estimator is fitted on."""
    counts, fit = [], estimator.fit

    def counted(self, dataset):
        counts.append(dataset.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        return fit(self, dataset)

    monkeypatch.setattr(estimator, "fit", counted)
    return counts


def _many(rated, rows):
    parts = [rated.withColumn("event_id", F.concat("event_id", F.lit(f"-{i}"))) for i in range(rows // 1000)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.coalesce(1)


def test_forest_is_trained_and_scored_by_all_tasks(spark, rated, monkeypatch):
    assert rated.count() == 1000
    rows = _many(rated, 40_000)
    counts = _partitions_of_fit(monkeypatch, classifier.RandomForestClassifier)
    model = classifier.train_classifier(rows, numTrees=2, maxDepth=2)
    assert len(counts[0]) == 3 and sum(counts[0]) == 40_000 and max(counts[0]) < 15_000
    scored = classifier.score(rows, model)
    assert scored.rdd.getNumPartitions() == 8 and scored.count() == 40_000
    # Few rows stay in the tasks where they are.
    classifier.train_classifier(rated.coalesce(1), numTrees=2, maxDepth=2)
    assert counts[1] == [1000]


def test_kept_sequences_have_tasks_of_bounded_rows(spark, rated, monkeypatch):
    counts = _partitions_of_fit(monkeypatch, shelf_life.GBTRegressor)
    shelf_life.train_shelf_life(_many(rated, 40_000), maxIter=1, maxDepth=2)
    assert len(counts[0]) == 3 and max(counts[0]) < 25_000
    assert sampling.tasks_for(rated, 36_000_000) == 180


def test_permutation_importance_equals_scoring_every_swap(spark, rated, model):
    rows = rated.limit(300).persist()
    got = {r.feature: r.accuracy_loss for r in classifier.permutation_importance(rows, model).collect()}
    inputs = classifier.with_inputs(rows).select("event_id", "spoiled", *classifier.INPUTS).collect()
    inputs.sort(key=lambda r: (hashlib.md5(f"{r.event_id}:42".encode()).hexdigest(), r.event_id))
    cases = []
    for at, row in enumerate(inputs):
        x, z = ([float(r[c]) for c in classifier.INPUTS] for r in (row, inputs[(at + 1) % len(inputs)]))
        cases.append((-1, row.spoiled, Vectors.dense(x)))
        cases += [(k, row.spoiled, Vectors.dense([*x[:k], z[k], *x[k + 1 :]])) for k in range(len(x))]
    tested = model.stages[-1].transform(spark.createDataFrame(cases, ["k", "y", "features"]))
    hits = dict(tested.groupBy("k").agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).collect())
    for k, name in enumerate(classifier.INPUTS):
        assert got[name] == pytest.approx(hits[-1] - hits[k], abs=1e-12)
    assert classifier.permutation_importance(rows.filter("false"), model).count() == 0
