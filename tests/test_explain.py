"""Explanations of scores against all coalitions of inputs, and their sums."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import pandas as pd
import pytest
from pyspark.sql import functions as F

from freshhaul.catalog import fixtures as fx
from freshhaul.models import classifier, explain
from freshhaul.models.classifier import INPUTS


@pytest.fixture(scope="module")
def fitted(readings):
    level = (F.when(F.col("temperature") > 8, 1).otherwise(0) + (F.col("humidity") > 80).cast("int")).cast("int")
    rows = fx.rated(readings).withColumn("spoiled", level)
    return rows, classifier.train_classifier(rows, numTrees=4, maxDepth=4)


def expected(tree, place, x, known):
    """Mean class shares of a tree where only the inputs in ``known`` are told."""
    node = tree[place]
    total = sum(node.weights)
    if node.left < 0:
        return [w / total for w in node.weights]
    if node.feature in known:
        return expected(tree, node.left if x[node.feature] <= node.threshold else node.right, x, known)
    sides = [(sum(tree[c].weights) / total, expected(tree, c, x, known)) for c in (node.left, node.right)]
    return [sum(w * side[c] for w, side in sides) for c in range(len(node.weights))]


def test_equals_all_coalitions(spark, fitted):
    rows, model = fitted
    few = rows.orderBy("event_id").limit(5)
    trees: dict = {}
    for node in explain.forest_nodes(spark, model).collect():
        trees.setdefault(node.tree, {})[node.id] = node
    assert len(trees) == 4 and any(len(t) > 7 for t in trees.values())
    inputs = classifier.with_inputs(few).select("event_id", *INPUTS).collect()
    got: dict = {}
    for r in explain.explain(few, model).collect():
        got.setdefault(r.event_id, {})[r.feature] = (r.p_fresh, r.p_at_risk, r.p_spoiled)
    assert len(got) == 5
    for row in inputs:
        x = [float(row[name]) for name in INPUTS]
        want = [[0.0] * 3 for _ in INPUTS]
        base = [0.0] * 3
        for tree in trees.values():
            used = sorted({n.feature for n in tree.values() if n.left >= 0})
            worth = {
                subset: expected(tree, 0, x, set(subset))
                for size in range(len(used) + 1)
                for subset in combinations(used, size)
            }
            for c in range(3):
                base[c] += worth[()][c] / len(trees)
                for subset, value in worth.items():
                    weight = factorial(len(subset)) * factorial(len(used) - len(subset) - 1) if len(subset) < len(used) else 0
                    for f in set(used) - set(subset):
                        gain = worth[tuple(sorted((*subset, f)))][c] - value[c]
                        want[f][c] += weight / factorial(len(used)) * gain / len(trees)
        for at, name in enumerate(INPUTS):
            assert got[row.event_id][name] == pytest.approx(want[at], abs=1e-9), name
        assert got[row.event_id][explain.BASE] == pytest.approx(base, abs=1e-9)


def test_parts_add_up(fitted):
    rows, model = fitted
    odd = rows.withColumn("temperature", F.when(F.col("event_id").like("%3"), None).otherwise(F.col("temperature")))
    odd = odd.union(odd.limit(20)).withColumn("key", F.lit("extra")).withColumn("x", F.lit(1))
    sums = explain.explain(odd, model).groupBy("event_id").agg(
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(explain.CLASSES)], F.count(F.lit(1)).alias("n")
    )
    both = classifier.score(odd, model).dropDuplicates(["event_id"]).join(sums, "event_id").collect()
    assert len(both) == rows.select("event_id").distinct().count()
    for r in both:
        times = r.n / (len(INPUTS) + 1)
        assert times in (1, 2)
        for i, c in enumerate(explain.CLASSES):
            assert r[f"s{i}"] / times == pytest.approx(r[c], abs=1e-4)
    assert explain.explain(rows.filter("false"), model).count() == 0


def test_mean_contributions(fitted):
    rows, model = fitted
    explained = explain.explain(rows.limit(50), model).persist()
    parts: dict = {}
    for r in explained.collect():
        parts.setdefault(r.feature, []).append(abs(r.p_spoiled))
    found = {r.feature: r.importance for r in explain.mean_contributions(explained).collect()}
    assert set(found) == set(INPUTS)
    for name, value in found.items():
        assert value == pytest.approx(sum(parts[name]) / 50)
    assert any(value > 0.01 for value in found.values())
    explained.unpersist()


def test_alike_rows_are_worked_out_once(spark, fitted, monkeypatch):
    """Rows on the same sides of a tree's splits have its values from one calculation."""
    rows, model = fitted
    forest = explain.leaf_paths(explain.forest_nodes(spark, model))
    x = [[float(r[c]) for c in INPUTS] for r in classifier.with_inputs(rows.limit(40)).collect()]
    seen, make = [], explain._tree_values

    def counted(leaves, used):
        base, values = make(leaves, used)
        return base, lambda part: (seen.append(len(part)), values(part))[1]

    monkeypatch.setattr(explain, "_tree_values", counted)
    run = explain._explainer(forest, len(INPUTS))
    many = pd.DataFrame({"key": range(4000), "x": x * 100})
    out = pd.concat(run(iter([many])))
    assert sum(seen) <= 40 * len(forest)
    alone = pd.concat(run(iter([many.iloc[i : i + 1] for i in range(40)])))
    for i in range(4000):
        assert out.v.iloc[i] == pytest.approx(alone.v.iloc[i % 40], abs=1e-12)
