import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensia.operators import ranking as R


def deciles(spark, scores):
    df = spark.createDataFrame([(f"t{i:04d}", s) for i, s in enumerate(scores)], "tok string, p double")
    out = R.assign_deciles(df, "p", ["tok"]).orderBy("tok").collect()
    return [r.score_decile for r in out]


def test_deciles_small_n(spark):
    assert deciles(spark, []) == []
    assert deciles(spark, [0.5, 0.5, 0.1]) == [7, 10, 4]


def test_deciles_n12_sizes(spark):
    got = deciles(spark, [i / 100 for i in range(12)])
    sizes = [got.count(d) for d in range(1, 11)]
    assert sizes == [2, 1, 1, 1, 1, 1, 1, 1, 1, 2]


@pytest.mark.parametrize("n", [9, 10, 11, 91])
def test_deciles_integer_form(spark, n):
    got = deciles(spark, [i / 1000 for i in range(n)])
    for r, d in enumerate(got, start=1):
        want = max(1, -(-10 * (r - 1) // (n - 1))) if n >= 10 else -(-10 * r // n)
        assert d == want


def test_multi_range_rank_equals_single_window(spark):
    rng = random.Random(7)
    # a third of all rows share one score: ties must spread over ranges
    rows = [(f"k{i:05d}", 0.5 if i % 3 == 0 else round(rng.random(), 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "tok string, p double")
    ranked, n = R.global_rank(df, ["p", "tok"], "r", rows_per_bucket=200)
    got = {r.tok: r.r for r in ranked.collect()}
    want = {r.tok: r.r for r in df.select("tok", F.row_number().over(Window.orderBy("p", "tok")).alias("r")).collect()}
    assert n == 3000 and got == want
    # ranges are balanced: no range holds the whole tied group
    sizes = R.with_ranges(df, ["p", "tok"], 3000, 200)[0].groupBy("_range").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 1000


def test_prefix_sums_with_nulls(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 5), (None, 1)], "k int, v int")
    out = R.prefix_sums(df, ["k"], {"s": F.col("v")}, rows_per_bucket=1).orderBy(F.col("k").asc_nulls_first()).collect()
    assert [r.s for r in out] == [1, 3, 3, 8]


@pytest.mark.parametrize("n,k", [(5, 1), (10, 1), (11, 2), (30, 3), (0, 0)])
def test_top_count(n, k):
    assert R.top_count(n) == k


def test_many_ranges_equal_single_window(spark):
    import datetime as dt

    rows = [(f"k{i:05d}", None if i % 50 == 0 else float(i % 11), dt.date(2024, 1, 1 + i % 28)) for i in range(2000)]
    df = spark.createDataFrame(rows, "tok string, p double, d date")
    for keys in (["p", "tok"], ["d", "p", "tok"]):
        ranked, _ = R.global_rank(df, keys, "r", rows_per_bucket=3)
        got = {r.tok: r.r for r in ranked.collect()}
        want = {r.tok: r.r for r in df.select("tok", F.row_number().over(Window.orderBy(*keys)).alias("r")).collect()}
        assert got == want


def test_integer_deciles_match_pandas_qcut():
    """The integer form equals pandas' qcut of first-ranks except where
    pandas' float bin edges land exactly on a rank (10 divides n - 1)."""
    import numpy as np
    import pandas as pd

    for n in range(10, 400):
        if (n - 1) % 10 == 0:
            continue
        ranks = pd.Series(np.arange(1, n + 1, dtype=float))
        want = pd.qcut(ranks, q=10, labels=range(1, 11)).astype(int).tolist()
        got = [max(1, -(-10 * (r - 1) // (n - 1))) for r in range(1, n + 1)]
        assert got == want, n
    for n in range(1, 10):
        want = np.ceil(np.arange(1, n + 1) / n * 10).astype(int).tolist()
        assert [-(-10 * r // n) for r in range(1, n + 1)] == want
