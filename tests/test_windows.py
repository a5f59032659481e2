"""Rolling sums and sliding distinct counts against plain loops."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from propensia.operators.windows import rolling_window, sliding_distinct


@pytest.mark.parametrize(("n", "rows_per_block"), [(1, 5), (4, 5), (30, 7), (500, 1000)])
def test_rolling_window_over_blocks(spark, n, rows_per_block):
    rng = random.Random(n)
    rows = [(None if i % 3 == 0 else rng.choice("abc"), rng.choice([None, rng.randint(0, 20)]), i, rng.choice([None, rng.randint(-5, 5)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o int, id int, v long").repartition(4)
    got = {r.id: r.s for r in rolling_window(df, {"s": ("v", n)}, ["k"], ["o", "id"], rows_per_block).collect()}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for i, r in enumerate(own):
            values = [x[3] for x in own[max(0, i - n + 1) : i + 1] if x[3] is not None]
            assert got[r[2]] == (sum(values) if values else None)


def test_rolling_window_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, o int, v long")
    out = rolling_window(empty, {"s": ("v", 3)}, ["k"], ["o"])
    assert out.columns == ["k", "o", "v", "s"] and out.count() == 0
    with pytest.raises(ValueError):
        rolling_window(empty, {"s": ("v", 0)}, ["k"], ["o"])


DAY = dt.date(2024, 2, 25)  # a leap day and a month's end lie inside


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 12)), st.one_of(st.none(), st.integers(0, 3))), max_size=40),
    st.integers(1, 6),
)
def test_sliding_distinct(spark, rows, days):
    rows = [(k, None if d is None else DAY + dt.timedelta(days=d), v) for k, d, v in rows]
    got = sorted((str(r.k), str(r.d), r.n) for r in sliding_distinct(spark.createDataFrame(rows, "k string, d date, v int"), "k", "d", "v", days, "n").collect())
    want = set()
    for k, d, _ in rows:
        if k is None or d is None:
            want.add((str(k), str(d), 0))
        else:
            want.add((k, str(d), len({v for x, e, v in rows if x == k and e and v is not None and 0 <= (d - e).days < days})))
    assert got == sorted(want)
