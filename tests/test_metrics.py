import math
import random

import pytest

from propensia.operators.metrics import evaluation_metrics


def brute_ap(y, p):
    """Average precision by its definition over distinct thresholds."""
    P = sum(y)
    if P == 0:
        return 0.0
    total = 0.0
    for t in sorted(set(p), reverse=True):
        sel = [yy for yy, pp in zip(y, p) if pp >= t]
        pos_at = sum(yy for yy, pp in zip(y, p) if pp == t)
        total += pos_at / P * (sum(sel) / len(sel))
    return total


def brute_auc(y, p):
    pos = [pp for yy, pp in zip(y, p) if yy == 1]
    neg = [pp for yy, pp in zip(y, p) if yy == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def run(spark, y, p):
    df = spark.createDataFrame([(f"t{i:04d}", yy, pp) for i, (yy, pp) in enumerate(zip(y, p))], "tok string, y int, p double")
    return evaluation_metrics(df, "y", "p", ["tok"]).first()


def test_perfect_inverted_tied(spark):
    y = [0, 0, 0, 1, 1]
    m = run(spark, y, [0.1, 0.2, 0.3, 0.8, 0.9])
    assert m.pr_auc == 1.0 and m.roc_auc == 1.0
    m = run(spark, y, [0.9, 0.8, 0.7, 0.2, 0.1])
    assert m.roc_auc == 0.0
    m = run(spark, y, [0.5] * 5)
    assert m.roc_auc == 0.5 and math.isclose(m.pr_auc, 0.4)


def test_no_positives(spark):
    m = run(spark, [0, 0, 0], [0.1, 0.2, 0.3])
    assert m.pr_auc == 0.0 and m.lift_at_10 == 0.0 and m.roc_auc is None


def test_against_definitions(spark):
    rng = random.Random(3)
    y = [1 if rng.random() < 0.2 else 0 for _ in range(400)]
    p = [round(rng.random(), 2) for _ in range(400)]  # many ties
    m = run(spark, y, p)
    assert math.isclose(m.pr_auc, brute_ap(y, p), rel_tol=1e-12)
    assert math.isclose(m.roc_auc, brute_auc(y, p), rel_tol=1e-12)
    assert math.isclose(m.brier_score, sum((a - b) ** 2 for a, b in zip(p, y)) / 400, rel_tol=1e-12)
    k = 40
    order = sorted(range(400), key=lambda i: (p[i], f"t{i:04d}"))[-k:]
    assert math.isclose(m.precision_at_10, sum(y[i] for i in order) / k)
    assert math.isclose(m.lift_at_10, m.precision_at_10 / m.prevalence)


def test_guard(spark):
    df = spark.createDataFrame([("a", 1, None)], "tok string, y int, p double")
    with pytest.raises(ValueError):
        evaluation_metrics(df, "y", "p", ["tok"])
