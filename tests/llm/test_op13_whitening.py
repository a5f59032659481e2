"""The bidiagonal solver against dense ones, and whitened rows against a plain computation."""

import math

import numpy as np
import pytest
from awkward_rows import SF0001
from propensia.llm import whitening as w

SCHEMA = "vec_id long, embedding array<double>, label int, id string, x long, n long, component int"


def matrices():
    rng = np.random.default_rng(1)
    hadamard = np.array([[1.0]])
    for _ in range(5):
        hadamard = np.block([[hadamard, hadamard], [hadamard, -hadamard]])
    deficient = rng.normal(size=(100, 20))
    deficient[:, 3], deficient[:, 7] = 0.0, deficient[:, 8]
    orthogonal = np.linalg.qr(rng.normal(size=(100, 30)))[0]
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    return {
        "random": rng.normal(size=(200, 40)),
        "graded": rng.normal(size=(200, 40)) @ np.diag(10.0 ** -np.arange(0, 12, 0.3)),
        "equal values": np.vstack([hadamard] * 2),
        "identity": np.eye(16),
        "deficient": deficient,
        "few rows": rng.normal(size=(4, 16)),
        "clustered": orthogonal @ np.diag([1 + 1e-9 * i for i in range(15)] + [0.5 + 1e-13 * i for i in range(15)]) @ turn.T,
        "close": np.diag(np.abs(np.arange(-10, 11)) + 0.1) + np.diag(np.ones(20), 1),
        "zero": np.zeros((4, 5)),
        "one": rng.normal(size=(9, 1)),
    }


@pytest.mark.parametrize("name", list(matrices()))
def test_solver(name):
    m = matrices()[name]
    d = m.shape[1]
    r = np.zeros((d, d))
    factor = np.linalg.qr(m, mode="r")
    r[: len(factor)] = factor
    values, vectors = w.singular_vectors(r)
    k = vectors.shape[1]
    assert k == np.linalg.matrix_rank(m)
    want = np.linalg.svd(m, compute_uv=False)[:k] ** 2
    assert np.allclose(values[:k], want, rtol=1e-9 if name == "graded" else 1e-12, atol=0)
    assert (values[k:] == 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(k)).max(initial=0) < 1e-11
    assert np.abs(m.T @ (m @ vectors) - vectors * values[:k]).max(initial=0) <= 1e-13 * max(values.max(), 1e-300) * d


def test_small_singular_values_are_accurate_relative_to_themselves():
    """A bidiagonal with entries over 30 orders of magnitude, against the same with integers of any length."""
    from fractions import Fraction

    a, b = np.array([1.0, 1e-6, 1e-14]), np.array([1e-3, 1e-10])
    values = w.dqds(a, b)
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    found = Fraction(1)
    for v in values:
        found *= Fraction(float(v))
    assert abs(found / product - 1) < 1e-14  # the determinant, smallest value included


def plain(ids, vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1_000_000
    n = len(x)
    spread = x * n - x.sum(0)
    c = spread / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > e[0] * 1e-12).sum()))
    return {i: ((spread[j].astype(object) ** 2).sum(), c[j] @ u[:, :k] / np.sqrt(e[:k])) for j, i in enumerate(ids)}, e[:k] / e.sum(), n


def check(rows, want, shares, n):
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(found) == set(want)
    signs = None
    for i, (deviation, white) in want.items():
        assert sorted(found[i]) == list(range(1, len(white) + 1))
        got = np.array([found[i][k + 1]["whitened"] for k in range(len(white))])
        signs = np.sign(got * white) if signs is None else signs
        assert np.abs(got - signs * white).max() < 1e-8
        for k in range(len(white)):
            r = found[i][k + 1]
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert math.isclose(r["explained"], shares[k], rel_tol=1e-9) and r["identity_error"] < 1e-9


def test_query_equals_dense_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()
    check(w.query(spark, SF0001).collect(), *plain([r["vec_id"] for r in rows], [r["embedding"] for r in rows]))


def test_factors_are_merged_over_many_tasks(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    frame = spark.createDataFrame([(i, [float(c) for c in v], *[None] * 5) for i, v in enumerate(x)], SCHEMA).repartition(100)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task a file
    try:
        rows = w.whiten(frame).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    check(rows, *plain(list(range(300)), x))


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [-1.0, 0.5]), (4, [0.25, -3.0]), (5, [7.0, 7.0])]
    bad = [(6, None), (7, []), (8, [None, 1.0]), (9, [nan, 1.0]), (10, [inf, 0.0]), (11, [1.0, 2.0, 3.0]), (12, [1e300, 0.0])]
    frame = spark.createDataFrame([(*r, *[None] * 5) for r in good + bad], SCHEMA)
    check(w.whiten(frame).collect(), *plain([1, 2, 3, 4, 5], [v for _, v in good]))
    # a null key and repeated rows stand for themselves
    more = spark.createDataFrame([(*r, *[None] * 5) for r in [*good, good[0], (None, [3.0, 3.0])]], SCHEMA)
    assert w.whiten(more).count() == 14


def test_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], *[None] * 5) for i in range(3)], SCHEMA)
    line = spark.createDataFrame([(i, [float(i), 1.0], *[None] * 5) for i in range(3)], SCHEMA)
    assert w.whiten(same).count() == 0
    assert {r["component"] for r in w.whiten(line).collect()} == {1}
    empty = w.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and empty.count() == 0


def test_deviations_beyond_64_bits_are_null():
    x, sums = np.array([[1 << 40, 0], [3, 5]]), np.array([(1 << 40) + 3, 5], dtype=object)
    got = w._deviations(x, 2, sums)
    spread = [[2 * int(v) - int(s) for v, s in zip(row, sums, strict=True)] for row in x]
    assert got == [t if t < 1 << 63 else None for t in (sum(v * v for v in row) for row in spread)]
    assert got[0] is None
