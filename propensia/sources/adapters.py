"""Bindings from the driver's tables to the raw transaction / label schema.

The test tables are not card transactions; these projections give them the
raw contract so the layers run over real, growing inputs. They are plain
column expressions (one narrow map over the scan, no shuffle).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions.expr import as_date_literal

# --- fixed values of the bindings ------------------------------------------
PAN_BASE = 4000000000000000
EVENTS_RUN_DATE = _dt.date(2024, 1, 31)
ORDERS_RUN_DATE = _dt.date(2001, 8, 2)
LABEL_BATCHES = [_dt.date(2024, 1, 24), _dt.date(2024, 1, 31)]
EVENT_CHANNELS = ["mobile", "Online", "app", "branch", "ATM", "agent", "kiosk"]
EVENT_TYPES = {"purchase": "POS", "view": "p2p", "click": "withdrawal", "signup": "bill_pay", "error": "chargeback"}
ORDER_CHANNELS = {"1-URGENT": "mobile", "2-HIGH": "Online", "3-MEDIUM": "branch", "4-NOT SPECIFIED": "ATM", "5-LOW": "agent"}
ORDER_TYPES = {"F": "purchase", "O": "transfer", "P": "deposit"}
ADOPTION_BALANCE = 7000
# --- end of fixed values ----------------------------------------------------


# Read schemas of the driver tables the bindings use (only the columns read).
# An explicit schema skips Parquet schema inference, which runs a Spark job.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def pan_of(customer_id) -> "F.Column":
    return (F.lit(PAN_BASE) + customer_id.cast("long")).cast("string")


def _epoch_seconds(d: _dt.date) -> int:
    return int(_dt.datetime(d.year, d.month, d.day, tzinfo=_dt.timezone.utc).timestamp())


def _sql_case(col: str, mapping: dict[str, str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _seed_sql(index_sql: str) -> str:
    codes = ", ".join(str(code) for code, _ in S.MCC_SEED)
    return f"element_at(array({codes}), CAST(({index_sql}) % {len(S.MCC_SEED)} AS INT) + 1)"


def _ingestion_sql(run_date: _dt.date) -> list[str]:
    return [
        f"DATE'{run_date.isoformat()}' AS _ingestion_date",
        f"timestamp_seconds({_epoch_seconds(run_date)}) AS _ingestion_timestamp",
        f"'batch-{run_date.isoformat()}' AS _batch_id",
    ]


def events_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one raw batch (dense days), run date 2024-01-31.

    Written as SQL expression strings: one JVM round trip per column.
    """
    channels = ", ".join(f"'{c}'" for c in EVENT_CHANNELS)
    return table(spark, sf_dir, "events").selectExpr(
        f"CAST({PAN_BASE} + user_id AS STRING) AS customer_token",
        "concat('txn_', lpad(CAST(event_id AS STRING), 9, '0')) AS transaction_id",
        "round(value - 1.0D, 2) AS amount",
        "CASE WHEN event_id % 10 < 8 THEN 'KES' WHEN event_id % 10 = 8 THEN 'USD' ELSE 'EUR' END AS currency",
        "CAST(ts AS TIMESTAMP_NTZ) AS transaction_timestamp",
        f"element_at(array({channels}), CAST(event_id % 7 AS INT) + 1) AS channel",
        f"{_sql_case('event_type', EVENT_TYPES)} AS transaction_type",
        f"{_seed_sql("CAST(get_json_object(props, '$.k') AS INT)")} AS merchant_mcc",
        "event_id % 20 = 0 AS is_cross_border",
        "21 + user_id % 50 AS customer_age",
        "1 + user_id % 120 AS tenure_months",
        *_ingestion_sql(EVENTS_RUN_DATE),
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as one raw batch (sparse days), run date 2001-08-02."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"CAST({PAN_BASE} + o_custkey AS STRING) AS customer_token",
        "concat('txn_', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS transaction_id",
        "o_totalprice / 100.0D - 20 AS amount",
        "CASE WHEN o_orderkey % 10 < 8 THEN 'KES' ELSE 'USD' END AS currency",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS transaction_timestamp",
        f"{_sql_case('o_orderpriority', ORDER_CHANNELS)} AS channel",
        f"{_sql_case('o_orderstatus', ORDER_TYPES)} AS transaction_type",
        f"{_seed_sql('o_orderkey')} AS merchant_mcc",
        "o_orderkey % 20 = 0 AS is_cross_border",
        "21 + o_custkey % 50 AS customer_age",
        "1 + o_custkey % 120 AS tenure_months",
        *_ingestion_sql(ORDERS_RUN_DATE),
    )


def customer_as_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as two label batches (2024-01-24 flipped where key % 10 = 0,
    then 2024-01-31), with the run-date partition columns a lake read keeps."""
    c = table(spark, sf_dir, "customer")
    label = f"CASE WHEN c_acctbal > {ADOPTION_BALANCE} THEN 1 ELSE 0 END"
    batches = []
    for i, run_date in enumerate(LABEL_BATCHES):
        adopted = f"CASE WHEN c_custkey % 10 = 0 THEN 1 - {label} ELSE {label} END" if i == 0 else label
        batches.append(
            c.selectExpr(
                f"CAST({PAN_BASE} + c_custkey AS STRING) AS customer_token",
                f"CAST({adopted} AS INT) AS adopted_card",
                "21 + c_custkey % 50 AS age",
                "1 + c_custkey % 120 AS tenure_months",
                f"DATE'{(run_date - _dt.timedelta(days=1)).isoformat()}' AS label_date",
                *_ingestion_sql(run_date),
                f"'{run_date:%Y}' AS year",
                f"'{run_date:%m}' AS month",
                f"'{run_date:%d}' AS day",
            )
        )
    return batches[0].unionByName(batches[1])


def feature_history(gold: DataFrame) -> DataFrame:
    """Two overlapping gold snapshots as a lake read returns them: run
    2024-01-24 (rows up to 2024-01-23, ``txn_count_30d + 1``) and run
    2024-01-31 (all rows). Keep-last must return the second version."""
    first, second = LABEL_BATCHES
    older = gold.filter(F.col("feature_date") <= F.date_sub(as_date_literal(first), 1)).withColumn(
        "txn_count_30d", F.col("txn_count_30d") + 1
    )
    tag = lambda df, d: df.select("*", F.lit(f"{d:%Y}").alias("year"), F.lit(f"{d:%m}").alias("month"), F.lit(f"{d:%d}").alias("day"))
    return tag(older, first).unionByName(tag(gold, second))
