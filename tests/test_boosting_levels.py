"""Boosting over many rows: what a level reads, what is left behind."""

import os
from urllib.parse import urlparse

import numpy as np
from conftest import SF0001

from propensia.operators import boosting as B
from propensia.operators import training as T
from propensia.plans import queries as Q


def test_levels_leave_no_copies_of_margins(spark, monkeypatch):
    """Margins go on from round to round; only the newest written ones are kept, until the end."""
    monkeypatch.setattr(B, "KEPT_ROUNDS", 2)
    monkeypatch.setattr(B, "BLOCK", 50)
    rng = np.random.default_rng(5)
    rows = [(*map(float, rng.normal(size=2)), int(rng.random() < 0.4), int(rng.integers(3))) for _ in range(500)]
    frame = spark.createDataFrame(rows, "a double, b double, y int, fold int").repartition(4)
    data = B.binned(frame, ["a", "b"], B.quantile_edges(frame, ["a", "b"]), "y", 1.5)
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    margins = lambda: {n for n in os.listdir(folder) if n.startswith(("rdd-", "propensia-margins"))}
    before, kept = margins(), spark.sparkContext._jsc.getPersistentRDDs().size()
    found = B.boost(data, 3, 1.5, 7, 2, 0.1, 0)
    assert margins() == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept
    for a, b in zip(sum(found, []), sum(B.boost(data, 3, 1.5, 7, 2, 0.1, 500), []), strict=True):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and (a.leaf == b.leaf).all()


def test_nodes_equal_a_walk_of_each_row():
    rng = np.random.default_rng(6)
    for depth in (1, 4, 9):
        splits = (1 << depth) - 1
        tree = B.Tree(rng.integers(-1, 3, splits), rng.integers(0, 64, splits), rng.normal(size=1 << depth))
        bins = rng.integers(0, 64, (3, 300)).astype(np.uint8)
        for row, value in zip(bins.T, tree.value(bins), strict=True):
            at = 0
            for level in range(depth):
                i = (1 << level) - 1 + at
                at = 2 * at + int(tree.feature[i] >= 0 and row[tree.feature[i]] > tree.bin[i])
            assert value == tree.leaf[at]


def test_the_training_frame_is_made_once(spark, monkeypatch):
    """Both labels are looked for in the written frame, not in another run of its lineage."""
    plans = []
    real = T.require_classes
    monkeypatch.setattr(T, "require_classes", lambda frame: plans.append(frame._jdf.queryExecution().toString()) or real(frame))
    monkeypatch.setattr(T, "fit_propensity_model", lambda train: None)
    Q._trained(spark, SF0001)
    assert len(plans) == 1 and "Join" not in plans[0] and "Window" not in plans[0]
