"""Bronze -> silver -> gold -> features -> mart, as lazy DataFrame functions.

Plan shape of the gold layer (see ``gold``): a partial + final hash
aggregate to the customer-day grain, then one exchange on the customer
token and one sort feeding a single Window operator that evaluates every
row frame (7/30/90 active days) and the 30-calendar-day range frame.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions import expr as X
from propensia.operators.windows import rolling_sql


def bronze(raw: DataFrame, run_date: _dt.date | str) -> DataFrame:
    """P1 + P2: keep this run's batch and fix the schema contract."""
    batch = raw.filter(F.col("_ingestion_date") == X.as_date_literal(run_date))
    return batch.selectExpr(*[f"CAST(`{src}` AS {typ}) AS `{dst}`" for src, typ, dst in S.BRONZE_CONTRACT])


def silver(bronze_df: DataFrame) -> DataFrame:
    """P3 + F1-F5: valid amounts, USD amounts, cleaned categories."""
    amount = F.col("amount")
    valid = bronze_df.filter((amount > S.AMOUNT_MIN_EXCLUSIVE) & (amount < S.AMOUNT_MAX_EXCLUSIVE))
    return valid.select(
        "customer_token",
        "transaction_id",
        "amount",
        "currency",
        X.currency_convert("amount", "currency").alias("amount_usd"),
        "transaction_timestamp",
        X.to_event_date("transaction_timestamp").alias("transaction_date"),
        X.channel_clean("channel").alias("channel_clean"),
        X.transaction_type_clean("transaction_type").alias("transaction_type_clean"),
        "merchant_mcc",
        X.merchant_category_group("merchant_mcc").alias("merchant_category_group"),
        "is_cross_border",
        "age",
        "tenure_months",
        "_ingestion_date",
        "_ingestion_timestamp",
        "_batch_id",
    )


def daily_customer(silver_df: DataFrame) -> DataFrame:
    """A1 + A2: customer-day grain.

    Grouping by (token, date) gets map-side partial aggregation, so a token
    holding a large share of all transactions is collapsed to one row per
    day and map task before anything is shuffled. ``merchant_mask`` carries
    the day's merchant groups as bits for the calendar-window diversity.
    """
    return silver_df.groupBy(
        "customer_token", F.col("transaction_date").alias("feature_date")
    ).agg(
        F.count(F.lit(1)).alias("daily_txn_count"),
        F.sum("amount_usd").alias("daily_volume_usd"),
        F.count_if(F.col("channel_clean") == "digital").alias("daily_digital_count"),
        F.count_if(F.col("is_cross_border")).alias("daily_cross_border_count"),
        F.avg("amount_usd").alias("daily_avg_txn_size"),
        F.max("age").alias("age"),
        F.max("tenure_months").alias("tenure_months"),
        F.bit_or(X.merchant_group_bit("merchant_category_group")).alias("merchant_mask"),
    )


def gold(daily: DataFrame) -> DataFrame:
    """W1-W4 + A3 + F8: rolling customer features, one row per customer-day.

    All frames share partition key and order key (``unix_date`` ascending,
    NULLs last), so Spark plans one exchange, one sort and one Window node.
    Merchant diversity counts distinct groups among transactions in the
    29-days-back-inclusive calendar range: the OR of the day masks over a
    RANGE frame, then a popcount. Equal to the correlated COUNT(DISTINCT)
    because every silver row of the token on those dates is in some day.

    Written as SQL window expressions (one JVM round trip per column when
    the plan is built; the optimizer sees the same plan either way).
    """
    spec = "PARTITION BY customer_token ORDER BY unix_date(feature_date) ASC NULLS LAST"

    def last(column: str, n: int) -> str:
        return rolling_sql(column, spec, n)

    cal = f"OVER ({spec} RANGE BETWEEN {S.DIVERSITY_CALENDAR_DAYS - 1} PRECEDING AND CURRENT ROW)"
    running = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cnt30 = last("daily_txn_count", 30)
    return daily.selectExpr(
        "customer_token",
        "feature_date",
        *[f"{last('daily_txn_count', n)} AS txn_count_{n}d" for n in S.ROW_WINDOWS],
        *[f"{last('daily_volume_usd', n)} AS volume_{n}d" for n in S.ROW_WINDOWS],
        f"CAST({last('daily_volume_usd', 30)} AS DOUBLE) / nullif(CAST({cnt30} AS DOUBLE), 0) AS avg_txn_size_30d",
        f"CAST({last('daily_digital_count', 30)} AS DOUBLE) / nullif(CAST({cnt30} AS DOUBLE), 0) AS digital_ratio_30d",
        f"{last('daily_cross_border_count', 90)} AS cross_border_count_90d",
        "age",
        "tenure_months",
        f"CAST(datediff(feature_date, max(feature_date) {running}) AS BIGINT) AS recency_days",
        f"""CASE WHEN customer_token IS NULL OR feature_date IS NULL THEN CAST(0 AS BIGINT)
                 ELSE CAST(bit_count(bit_or(merchant_mask) {cal}) AS BIGINT) END AS merchant_diversity_30d""",
    )


def features(gold_df: DataFrame, run_date: _dt.date | str) -> DataFrame:
    """P4 + F6: the day-before-run snapshot with its engagement segment."""
    snap = gold_df.filter(F.col("feature_date") == F.date_sub(X.as_date_literal(run_date), 1))
    return snap.select("*", X.engagement_segment("txn_count_30d", "digital_ratio_30d").alias("engagement_segment"))


def mart(features_df: DataFrame, scores: DataFrame) -> DataFrame:
    """J2 + P12: snapshot customers joined to their published scores."""
    f = features_df.select("customer_token", "feature_date")
    s = scores.select(
        "customer_token",
        "propensity_score",
        "score_decile",
        "campaign_segment",
        F.col("feature_date").cast("date").alias("feature_date"),
    )
    j = f.join(s, on=["customer_token", "feature_date"], how="inner")
    return j.select(*S.SCORE_COLUMNS)


def mcc_seed_check(silver_df: DataFrame, seed: DataFrame) -> DataFrame:
    """Rule-based MCC groups against the seed, per MCC seen in silver.

    The seed is a fixed 20-row dimension, so broadcasting it is size-safe;
    the fact side is pre-aggregated per MCC before the join.
    """
    per_mcc = silver_df.groupBy("merchant_mcc").agg(F.count(F.lit(1)).alias("transactions"))
    per_mcc = per_mcc.withColumn("rule_group", X.merchant_category_group("merchant_mcc"))
    j = per_mcc.join(F.broadcast(seed.withColumnRenamed("merchant_category_group", "seed_group")), "merchant_mcc", "left")
    return j.select(
        "merchant_mcc",
        "transactions",
        "rule_group",
        "seed_group",
        F.coalesce(F.col("rule_group") == F.col("seed_group"), F.lit(False)).alias("agrees"),
    )
