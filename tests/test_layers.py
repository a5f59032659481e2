import datetime as dt

from pyspark.sql import functions as F

from propensia.operators import layers as L

SILVER = ("customer_token string, transaction_date date, amount_usd double, channel_clean string, "
          "is_cross_border boolean, age int, tenure_months int, merchant_category_group string")


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def test_row_frame_counts_active_days_and_diversity_calendar(spark):
    start = dt.date(2024, 1, 1)
    # 31 active days spread over 62 days (every other day)
    rows = [("c", start + dt.timedelta(days=2 * i), 1.0, "digital", False, 30, 12,
             ["grocery_retail", "other"][i % 2]) for i in range(31)]
    g = L.gold(L.daily_customer(silver(spark, rows))).orderBy("feature_date").collect()
    last = g[-1]
    assert last.txn_count_30d == 30  # 30 active-day rows, not 30 calendar days
    assert last.txn_count_90d == 31
    assert last.merchant_diversity_30d == 2
    assert all(r.recency_days == 0 for r in g)


def test_frames_differ_on_sparse_days(spark):
    rows = [("c", dt.date(2024, 1, 1), 2.0, "branch", True, 30, 12, "grocery_retail"),
            ("c", dt.date(2024, 2, 9), 4.0, "digital", False, 30, 12, "other")]
    g = L.gold(L.daily_customer(silver(spark, rows))).orderBy("feature_date").collect()
    assert g[1].txn_count_30d == 2  # two active-day rows
    assert g[1].merchant_diversity_30d == 1  # only day 40 is inside 30 calendar days
    assert g[1].cross_border_count_90d == 1
    assert g[1].digital_ratio_30d == 0.5


def test_all_null_usd_day(spark):
    rows = [("c", dt.date(2024, 1, 1), None, "atm", False, 30, 12, "other")]
    r = L.gold(L.daily_customer(silver(spark, rows))).first()
    assert r.volume_30d is None and r.txn_count_30d == 1 and r.avg_txn_size_30d is None


def test_features_snapshot_filters_day_before_run(spark):
    rows = [("c", dt.date(2024, 1, 29), 1.0, "atm", False, 30, 12, "other"),
            ("c", dt.date(2024, 1, 30), 1.0, "atm", False, 30, 12, "other")]
    f = L.features(L.gold(L.daily_customer(silver(spark, rows))), "2024-01-31").collect()
    assert [r.feature_date for r in f] == [dt.date(2024, 1, 30)]
    assert f[0].engagement_segment == "dormant"


def test_gold_plan_single_exchange_on_token(spark):
    rows = [("c", dt.date(2024, 1, 1), 1.0, "atm", False, 30, 12, "other")]
    plan = L.gold(L.daily_customer(silver(spark, rows)))._jdf.queryExecution().executedPlan().toString()
    # one Window node evaluates every frame
    assert plan.count("Window [") == 1


def test_attach_customer_attributes(spark):
    from propensia.operators.behaviour import attach_customer_attributes

    tx = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("z", 3.0)], "customer_token string, amount double")
    cu = spark.createDataFrame([("a", 30, 5), ("b", 40, 6)], "customer_token string, age int, tenure_months int")
    got = {r.customer_token: (r.age, r.tenure_months) for r in attach_customer_attributes(tx, cu).collect()}
    assert got == {"a": (30, 5), "b": (40, 6), "z": (None, None)}
