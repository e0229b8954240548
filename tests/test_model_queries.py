"""Values of the model queries, which no SQL gives."""

from __future__ import annotations

import pytest
from compare import connect
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from freshhaul.catalog import fixtures as fx
from freshhaul.plans.training import CLASSIFIER, REGRESSOR, training_table

QUERIES = queries()


@pytest.fixture(scope="module")
def by_sql(sf_dir):
    con = connect(sf_dir)
    return lambda name: con.execute(oracle_sql()[name]).fetchall()


def test_both_sources_appear(spark, sf_dir, by_sql):
    got = {r.truck_id: r for r in QUERIES["ml3_latest_model_or_rule"](spark, sf_dir).collect()}
    formula = {truck: hours for truck, hours, _ in by_sql("ml3_latest_or_rule")}
    assert got.keys() == formula.keys()
    for truck, row in got.items():
        few = int(truck[4:]) % 7 == 0
        assert row.source == ("rule" if few else "model")
        if few:
            assert row.hours == formula[truck]
    assert {r.source for r in got.values()} == {"model", "rule"}
    assert any(r.hours != formula[t] for t, r in got.items())


def test_hours_and_errors(spark, sf_dir, by_sql):
    rows = QUERIES["ml3_shelf_life_hours"](spark, sf_dir).collect()
    assert sorted(r.truck_id for r in rows) == sorted(r[0] for r in by_sql("ml3_shelf_life_latest"))
    assert len({r.predicted_hours for r in rows}) > 1
    assert all(0 <= r.predicted_hours == round(r.predicted_hours, 1) for r in rows)
    assert all(0 < r.model_mae < r.mean_mae for r in rows)


@pytest.mark.parametrize("name", ["ml1_ml2_probabilities", "ml2_production_scores"])
def test_probabilities(spark, sf_dir, by_sql, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    want = {event: (number, label) for event, number, label, _ in by_sql("ml1_ml2_classifier_scores")}
    assert {r.event_id: (r.predicted_class, r.predicted_label) for r in rows} == want
    for r in rows:
        p = (r.p_fresh, r.p_at_risk, r.p_spoiled)
        assert sum(p) == pytest.approx(1, abs=0.001) and p[r.predicted_class] == max(p)
    assert len({r.p_spoiled for r in rows}) > 3


def test_two_runs(spark, sf_dir):
    rows = {(r.model, r.version): r for r in QUERIES["jb6_two_runs"](spark, sf_dir).collect()}
    assert set(rows) == {(m, v) for m in (CLASSIFIER, REGRESSOR) for v in (1, 2)}
    table = training_table(fx.readings(spark, sf_dir))
    total = {CLASSIFIER: table.filter(F.col("spoiled").isNotNull()).count(), REGRESSOR: table.count()}
    for (model, version), r in rows.items():
        assert r.train_rows > r.test_rows > 0 and r.train_rows + r.test_rows == total[model]
        first, second = rows[model, 1].metric, rows[model, 2].metric
        assert first is not None and second is not None
        better = second >= first if model == CLASSIFIER else second <= first
        if version == 1:
            assert (r.decision, r.stage) == ("promote", "Archived" if better else "Production")
        else:
            assert (r.decision, r.stage) == (("promote", "Production") if better else ("keep", "None"))
