"""Boosted trees and isotonic calibration against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensia.operators import boosting as B

FEATURES = ["a", "b", "c"]


def table(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), np.round(rng.exponential(size=n), 1)])
    y = (x[:, 0] + 0.4 * x[:, 1] - x[:, 2] + rng.normal(size=n) > 1).astype(int)
    fold = rng.integers(0, 3, n)
    rows = [(*map(float, v), int(t), int(k)) for v, t, k in zip(x, y, fold, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y int, fold int").repartition(5), x, y, fold


def plain_trees(x, y, weight, edges, rounds, depth, step):
    """Margins of all rows by a recursive booster without bins or arrays of nodes."""
    unit = 2.0**-24
    margin = np.zeros(len(y))
    predictors = []

    def build(rows, g, h, level):
        total_g, total_h = g[rows].sum() * unit, h[rows].sum() * unit
        best = (1e-9, None, None)
        for f, cuts in enumerate(edges):
            for c in cuts:
                left = rows & (x[:, f] <= c)
                right = rows & ~left
                gl, hl, gr, hr = g[left].sum() * unit, h[left].sum() * unit, g[right].sum() * unit, h[right].sum() * unit
                if hl >= 1 and hr >= 1:
                    gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - total_g * total_g / (total_h + 1)
                    if gain > best[0]:
                        best = (gain, f, c)
        if level == depth or best[1] is None:
            return -step * total_g / (total_h + 1)
        left = rows & (x[:, best[1]] <= best[2])
        return best[1], best[2], build(left, g, h, level + 1), build(rows & ~left, g, h, level + 1)

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        root = build(np.ones(len(y), dtype=bool), np.rint(w * (p - y) / unit), np.rint(w * p * (1 - p) / unit), 0)
        margin = margin + np.array([value(root, row) for row in x])
        predictors.append(root)
    return lambda rows: sum(np.array([value(t, r) for r in rows]) for t in predictors)


@pytest.mark.parametrize("local_rows", [10_000, 0])
def test_predictions_equal_a_plain_version(spark, local_rows):
    frame, x, y, fold = table(spark)
    edges = B.quantile_edges(frame, FEATURES)
    data = B.binned(frame, FEATURES, edges, "y", 2.5)
    trees = B.boost(data, 3, 2.5, 4, 3, 0.3, local_rows)
    for k in range(3):
        want = plain_trees(x[fold != k], y[fold != k], 2.5, edges, 4, 3, 0.3)(x)
        assert np.allclose(B.raw_margin(trees[k], B.cut(x, edges)), want, atol=1e-12)


def test_levels_by_spark_and_in_a_task_give_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(B, "KEPT_ROUNDS", 3)
    frame, *_ = table(spark, 600, 1)
    edges = B.quantile_edges(frame, FEATURES)
    data = B.binned(frame, FEATURES, edges, "y", 3.0)
    one, other = (B.boost(data, 3, 3.0, 8, 4, 0.1, rows) for rows in (10_000, 0))
    for a, b in zip(sum(one, []), sum(other, []), strict=True):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and (a.leaf == b.leaf).all()


def brute_isotonic(points):
    """Min-max formula: max over starts of the min over ends of the mean."""
    out = []
    for i in range(len(points)):
        out.append(max(min(sum(t for _, t, _ in points[a : b + 1]) / sum(w for _, _, w in points[a : b + 1]) for b in range(i, len(points))) for a in range(i + 1)))
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_isotonic_values_equal_the_min_max_formula(spark, partitions):
    rng = np.random.default_rng(4)
    rows = []
    for fold in range(2):
        p = np.unique(np.round(rng.random(60), 3))
        for v in p:
            weight = int(rng.integers(1, 5))
            rows.append((fold, float(v), float(rng.binomial(weight, v if fold else 1 - v)), float(weight)))
    got = B.isotonic(spark.createDataFrame(rows, "fold int, p double, total double, weight double").repartition(5), partitions, 3).collect()
    for fold in range(2):
        points = sorted((p, t, w) for f, p, t, w in rows if f == fold)
        blocks = sorted((b.low, b.high, b.total / b.weight) for b in got if b.fold == fold)
        values = [next(v for low, high, v in blocks if low <= p <= high) for p, _, _ in points]
        assert np.allclose(values, brute_isotonic(points))
        assert all(x[2] < y[2] for x, y in zip(blocks, blocks[1:], strict=False))


def test_model_round_trip_and_missing_features(spark, scratch):
    from propensia.sources import lake as IO

    frame, x, y, fold = table(spark, 500, 2)
    model = B.fit(frame, FEATURES, "y", 2.0, folds=3, rounds=5, depth=3, step=0.2)
    IO.save_model(model, f"{scratch}/model")
    loaded = IO.load_model(f"{scratch}/model")
    assert IO.model_features(loaded) == FEATURES
    scores = [r.propensity_score for r in loaded.transform(frame.orderBy("a", "b", "c")).select("propensity_score").collect()]
    order = np.lexsort((x[:, 2], x[:, 1], x[:, 0]))
    assert np.allclose(scores, model.fold_scores(x[order]).mean(axis=1))
    auc = np.mean([(s > t) + 0.5 * (s == t) for s, a in zip(scores, y[order]) if a for t, b in zip(scores, y[order]) if not b])
    assert auc > 0.8
    gone = spark.createDataFrame([(None, 1.0, 1.0)], "a double, b double, c double")
    assert 0 <= loaded.transform(gone).first().propensity_score <= 1
    assert loaded.transform(frame.filter(F.lit(False))).count() == 0
