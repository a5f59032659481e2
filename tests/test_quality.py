import datetime as dt

import pytest

from propensia.operators import quality as Q


def test_report_counts_and_gate(spark):
    rows = [("a", 1.0, "digital", dt.date(2024, 1, 1)), ("a", -1.0, "web", dt.date(2024, 1, 1)),
            (None, None, "web2", dt.date(2024, 2, 1)), ("b", 2.0, None, None)]
    df = spark.createDataFrame(rows, "k string, amount double, ch string, d date")
    checks = [Q.not_null("k"), Q.unique("k"), Q.positive("amount"), Q.accepted_values("ch", ["digital"]),
              Q.accepted_range("amount", 0, 1.5), Q.unique_combination("k", "d"), Q.no_future_peeking("d", "2024-01-15")]
    got = {(r.check, r.column): r.failures for r in Q.quality_report(df, checks, "t").collect()}
    assert got == {
        ("not_null", "k"): 1,
        ("unique", "k"): 1,
        ("positive", "amount"): 2,
        ("accepted_values", "ch"): 2,  # distinct offending values; NULL passes
        ("accepted_range", "amount"): 2,
        ("unique_combination", "k,d"): 1,
        ("no_future_peeking", "d"): 1,
    }
    with pytest.raises(Q.QualityGateError):
        Q.assert_passing(Q.quality_report(df, checks, "t"))
    Q.assert_passing(Q.quality_report(df.filter("k = 'a' and amount > 0"), checks, "t"))


def test_all_checks_take_one_scan_and_tell_nulls_apart(spark):
    rows = [("a", None, 1.0), (None, "a", -1.0), ("a", None, None), ("b", "x", 2.0), ("b", "y", 3.0), (None, None, 0.0), (None, None, 9.0)]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    checks = [Q.unique("k"), Q.unique_combination("k", "m"), Q.unique_combination("m", "k"), Q.accepted_values("m", ["a", "x"]), Q.positive("v"), Q.not_null("k"), Q.accepted_range("v", 0, 5)]
    report = Q.quality_report(df, checks, "t")
    got = [(r.check, r.column, r.failures) for r in report.collect()]
    assert sorted(got) == sorted(
        [("unique", "k", 2), ("unique_combination", "k,m", 2), ("unique_combination", "m,k", 2), ("accepted_values", "m", 1),
         ("positive", "v", 3), ("not_null", "k", 3), ("accepted_range", "v", 2)]
    )
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 2  # the initial and the final plan of one scan
    empty = Q.quality_report(df.limit(0), checks, "t").collect()
    assert len(empty) == len(checks) and all(r.failures == 0 for r in empty)
