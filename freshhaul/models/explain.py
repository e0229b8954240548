"""Why a row got its score: Shapley values of the forest's inputs.

An input that is left out of a coalition follows both branches of a split, weighted by the
training rows that went each way. For one leaf the game is then a product over the inputs
of its path: 1 or 0 for an input that is in (does the row take the path), the share of
training rows for one that is out. The Shapley value of a factor of such a product is an
integral over [0, 1] of a polynomial, which Gauss-Legendre points give without error, so
no coalition is ever listed. Values of all leaves add up to the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshhaul.models.classifier import INPUTS, with_inputs
from freshhaul.models.forest import StoredForest, node_table
from freshhaul.session import scratch_path

BASE = "(base)"
CLASSES = ["p_fresh", "p_at_risk", "p_spoiled"]
ROWS, LEAVES = 256, 256  # pieces of rows and of a tree's leaves that are worked on at a time


def forest_nodes(spark: SparkSession, model: PipelineModel | StoredForest) -> DataFrame:
    """One row per node of the stored forest: tree, id, children, split and class weights."""
    if isinstance(model, StoredForest):
        return model.nodes()
    path = scratch_path(spark, "forest")
    model.stages[-1].write().overwrite().save(path)
    return node_table(spark, path)


def leaf_paths(nodes: DataFrame) -> list[list[tuple[list[float], dict[int, tuple[float, float, float]]]]]:
    """For each tree, (class shares, {feature: (low, high, share)}) of each of its leaves.

    A row takes the path where low < value <= high holds for each of its features; share is
    the part of the training weight that the feature's splits let through. The size is that
    of the model, at most trees x 2^depth leaves, which Spark's own model holds on the
    driver as well; it does not grow with the data.
    """
    trees: dict[int, dict[int, object]] = {}
    for node in nodes.collect():
        trees.setdefault(node.tree, {})[node.id] = node
    forest = []
    for tree in trees.values():
        leaves = []
        todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while todo:
            place, path = todo.pop()
            node = tree[place]
            weight = sum(node.weights)
            if node.left < 0:
                leaves.append(([w / weight / len(trees) for w in node.weights], path))
                continue
            low, high, share = path.get(node.feature, (-np.inf, np.inf, 1.0))
            for child, bounds in (
                (node.left, (low, min(high, node.threshold))),
                (node.right, (max(low, node.threshold), high)),
            ):
                passed = share * sum(tree[child].weights) / weight
                todo.append((child, path | {node.feature: (*bounds, passed)}))
        forest.append(leaves)
    return forest


def _tree_values(leaves: list, used: list[int]) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Base of a tree, and a function from rows of x to their values, (used inputs x classes) columns."""
    longest = max(1, max(len(path) for _, path in leaves))
    inputs, classes = len(used), len(leaves[0][0])
    place = {number: at for at, number in enumerate(used)}
    feature = np.full((len(leaves), longest), inputs)  # short paths end in factors of one
    low, high = np.full(feature.shape, -np.inf), np.full(feature.shape, np.inf)
    share = np.ones(feature.shape)
    for at, (_, path) in enumerate(leaves):
        for slot, (number, (below, above, passed)) in enumerate(path.items()):
            feature[at, slot], low[at, slot], high[at, slot] = place[number], below, above
            share[at, slot] = passed
    value = np.array([shares for shares, _ in leaves])
    base = (value * share.prod(1)[:, None]).sum(0)
    points, weights = np.polynomial.legendre.leggauss((longest + 1) // 2)
    u, weights = (points + 1) / 2, weights / 2
    leaves_at_once = LEAVES

    def values(x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), (inputs + 1) * classes))
        x = np.vstack([x[:, used].T, np.zeros(len(x))])
        for start in range(0, len(feature), leaves_at_once):
            piece = slice(start, start + leaves_at_once)
            f, z = feature[piece], share[piece][..., None]
            there = x[f.ravel()].reshape(*f.shape, -1)  # leaves x slots x rows
            below, above = low[piece][..., None], high[piece][..., None]
            taken = (~(there <= below) & ((there <= above) | np.isinf(above))).astype(float)
            absent = z * (1 - u)  # leaves x slots x points
            present = absent + u
            logs = np.log(present) - np.log(absent)
            total = np.log(absent).sum(1)[..., None] + np.log(weights)[:, None]
            product = np.exp(np.matmul(logs.transpose(0, 2, 1), taken) + total)
            without = np.matmul(1 / absent, product)
            with_it = np.matmul(1 / present, product)
            parts = (without + taken * (with_it - without)) * (taken - z)
            to = np.zeros((f.size, inputs + 1, classes))
            to[np.arange(f.size), f.ravel()] = np.repeat(value[piece], f.shape[1], axis=0)
            out += parts.reshape(f.size, -1).T @ to.reshape(f.size, -1)
        return out[:, : inputs * classes]

    return base, values


def _explainer(forest: list, inputs: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Task function: rows (key, x) to (key, values), inputs x classes, the base last.

    The values of a tree depend only on the side of each of its splits that a row is on.
    Rows of a batch that are alike in that are worked out once for the tree.
    """
    classes = len(forest[0][0][0])
    ends: dict[int, set[float]] = {}
    for leaves in forest:
        for _, path in leaves:
            for number, (below, above, _) in path.items():
                ends.setdefault(number, set()).update(t for t in (below, above) if np.isfinite(t))
    cuts = {number: np.array(sorted(found)) for number, found in ends.items()}
    base, trees = np.zeros(classes), []
    for leaves in forest:
        used = sorted({number for _, path in leaves for number in path})
        own, values = _tree_values(leaves, used)
        base += own
        steps = {}  # side of the tree's splits for each side of the forest's
        for number in used:
            mine = {t for _, path in leaves if number in path for t in path[number][:2]}
            steps[number] = np.concatenate([[0], np.cumsum([t in mine for t in cuts[number]])])
        columns = [number * classes + c for number in used for c in range(classes)]
        trees.append((steps, values, columns))
    rows_at_once = ROWS

    def alike(sides: dict[int, np.ndarray], steps: dict[int, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of each kind that the tree can tell apart, and the kind of each row."""
        code, size = np.zeros(n, dtype=np.int64), 1
        for number, step in steps.items():
            if size * (int(step[-1]) + 1) >= 2**62:
                code = np.unique(code, return_inverse=True)[1]
                size = n
            size *= int(step[-1]) + 1
            code = code * (step[-1] + 1) + step[sides[number]]
        _, first, kind = np.unique(code, return_index=True, return_inverse=True)
        return first, kind

    def explained(x: np.ndarray) -> np.ndarray:
        out = np.zeros(((inputs + 1) * classes, len(x)))
        sides = {number: np.searchsorted(cut, x[:, number]) for number, cut in cuts.items()}
        for steps, values, columns in trees:
            first, kind = alike(sides, steps, len(x))
            pieces = [values(x[first[at : at + rows_at_once]]) for at in range(0, len(first), rows_at_once)]
            for column, found in zip(columns, np.concatenate(pieces).T):
                out[column] += found[kind]
        out[inputs * classes :] = base[:, None]
        return np.ascontiguousarray(out.T)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = explained(np.array(batch["x"].tolist(), dtype=float))
                yield pd.DataFrame({"key": batch["key"].to_numpy(), "v": list(found)})

    return run


def explain(df: DataFrame, model: PipelineModel | StoredForest, key: str = "event_id") -> DataFrame:
    """(key, feature, p_fresh, p_at_risk, p_spoiled): what each input adds to each probability.

    One row per input and one named ``(base)``, the mean score of the training rows; those
    of one key add up to its probabilities. Every row is explained where it lies, without a
    shuffle; a task holds the model and an Arrow batch. Rows without a key are explained as well;
    an empty table gives no rows.
    """
    forest = leaf_paths(forest_nodes(df.sparkSession, model))
    classes = len(forest[0][0][0])
    drawn = with_inputs(df.withColumn("_key", F.col(key))).select(
        F.col("_key").alias("key"), F.array(*[F.col(c).cast("double") for c in INPUTS]).alias("x")
    )
    kind = drawn.schema["key"].dataType.simpleString()
    found = drawn.mapInPandas(_explainer(forest, len(INPUTS)), f"key {kind}, v array<double>")
    named = F.array(*[F.lit(name) for name in [*INPUTS, BASE]])
    each = found.select("key", "v", F.posexplode(named).alias("at", "feature"))
    share = [F.get("v", F.col("at") * classes + c) if c < classes else F.lit(0.0) for c in range(len(CLASSES))]
    return each.select(F.col("key").alias(key), "feature", *[s.alias(n) for s, n in zip(share, CLASSES)])


def mean_contributions(explained: DataFrame) -> DataFrame:
    """(feature, importance): mean size of an input's part in P(spoiled), the base left out."""
    parts = explained.filter(F.col("feature") != BASE)
    return parts.groupBy("feature").agg(F.avg(F.abs("p_spoiled")).alias("importance"))
