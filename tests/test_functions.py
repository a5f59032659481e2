import datetime as dt
import hashlib
import hmac

from pyspark.sql import functions as F

from propensia.functions import expr as X
from propensia.functions.tokenize import stable_customer_token
from propensia.operators import layers as L


def col(spark, values, typ, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_currency(spark):
    df = spark.createDataFrame([(130.0, "KES"), (5.0, "USD"), (5.0, "EUR"), (5.0, None)], "a double, c string")
    assert [r[0] for r in df.select(X.currency_convert("a", "c")).collect()] == [1.0, 5.0, None, None]


def test_channel(spark):
    got = col(spark, ["MOBILE", "App", "online", "Branch", "web", None], "string", X.channel_clean)
    assert got == ["digital", "digital", "digital", "branch", "unknown", "unknown"]


def test_transaction_type(spark):
    got = col(spark, ["POS", "P2P", "refund", None], "string", X.transaction_type_clean)
    assert got == ["purchase", "transfer", "other", "other"]


def test_mcc_edges(spark):
    codes = [4110, 4111, 4789, 4790, 5410, 5411, 5499, 5500, 5811, 5812, 5814, 5815, 6009, 6010, 6051, 6052, None]
    got = col(spark, codes, "int", X.merchant_category_group)
    assert got == [
        "other", "transport_travel", "transport_travel", "other", "other", "grocery_retail", "grocery_retail", "other",
        "other", "food_beverage", "food_beverage", "other", "other", "financial_services", "financial_services", "other", "other",
    ]


def test_engagement(spark):
    rows = [(20, 0.7), (20, 0.69), (10, 0.4), (10, 0.39), (5, None), (4, 1.0)]
    df = spark.createDataFrame(rows, "n long, r double")
    got = [r[0] for r in df.select(X.engagement_segment("n", "r")).collect()]
    assert got == ["power_digital", "active_digital", "active_digital", "casual", "casual", "dormant"]


def test_campaign_segments(spark):
    got = col(spark, list(range(1, 11)), "int", X.campaign_segment)
    assert got == ["EXCLUDE"] * 3 + ["NURTURE"] * 3 + ["TARGET_STANDARD"] * 2 + ["TARGET_PREMIUM"] * 2


def test_amount_bounds(spark):
    rows = [(a,) for a in [-1.0, 0.0, 0.01, 9999999.99, 10000000.0, None]]
    raw = spark.createDataFrame(rows, "amount double")
    for c, t in [("customer_token", "string"), ("transaction_id", "string"), ("currency", "string"), ("channel", "string"),
                 ("transaction_type", "string"), ("merchant_mcc", "int"), ("is_cross_border", "boolean"), ("age", "int"),
                 ("tenure_months", "int"), ("_ingestion_date", "date"), ("_ingestion_timestamp", "timestamp_ntz"), ("_batch_id", "string")]:
        raw = raw.withColumn(c, F.lit(None).cast(t))
    raw = raw.withColumn("transaction_timestamp", F.lit(None).cast("timestamp_ntz"))
    got = sorted(r.amount for r in L.silver(raw).collect())
    assert got == [0.01, 9999999.99]


def test_token_matches_python_hmac(spark):
    key, pan = "k3y", "4000000000000042"
    got = spark.createDataFrame([(pan,)], "pan string").select(stable_customer_token("pan", key, "salt")).first()[0]
    want = hmac.new(key.encode(), f"salt:{pan}".encode(), hashlib.sha256).hexdigest()[:32]
    assert got == want
    long_key = "x" * 100  # keys longer than a block are hashed first
    got = spark.createDataFrame([(pan,)], "pan string").select(stable_customer_token("pan", long_key, "salt")).first()[0]
    assert got == hmac.new(long_key.encode(), f"salt:{pan}".encode(), hashlib.sha256).hexdigest()[:32]


def test_hive_parts_zero_padded(spark):
    df = spark.createDataFrame([(dt.date(2024, 8, 3),)], "d date")
    assert tuple(df.select(*X.hive_parts("d")).first()) == ("2024", "08", "03")


def test_probability_decile_and_lift(spark):
    df = spark.createDataFrame([(0.8234,), (0.0,), (1.0,), (0.05,)], "p double")
    got = df.select(X.probability_decile("p"), X.format_lift(X.expected_lift("p"))).collect()
    assert [tuple(r) for r in got] == [(9, "27.4x"), (1, "0.0x"), (10, "33.3x"), (1, "1.7x")]


def test_round_half_away_is_binary_exact(spark):
    df = spark.createDataFrame([(265.7200625,), (-1.5,), (2.5e-7,), (None,)], "x double")
    got = [r[0] for r in df.select(X.round_half_away("x", 6)).collect()]
    assert got[1] == -1.5 and got[3] is None
    assert abs(got[0] - 265.720062) < 1e-9 or abs(got[0] - 265.720063) < 1e-9
