"""Registered queries that go through a lake: written below the shared folder,
read back, filtered, rerun. Each run uses a new folder.

Also here: a dense binding (``lineitem`` by supplier and ship date, hundreds of
active days a customer, two ingestion dates), and the guards on spoiled input.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.operators import layers as L
from propensia.plans import jobs as J
from propensia.plans import oracle as O
from propensia.plans.queries import events_layers, holdout_metrics, metrics_sql, register, request_bodies, request_sql, rounded_gold, score9, training_inputs
from propensia.session import checkpoint_dir
from propensia.sources import adapters as A
from propensia.sources import lake as IO

FIRST_RUN, SECOND_RUN = _dt.date(2024, 1, 17), _dt.date(2024, 1, 31)
CUT = "2024-01-16"  # events before it belong to the first batch


def new_lake(spark: SparkSession) -> J.Lake:
    return J.Lake(f"{checkpoint_dir(spark).rstrip('/')}/propensia-lake-{uuid.uuid4().hex}")


def _with_pan(spark, sf_dir) -> DataFrame:
    return A.events_as_transactions(spark, sf_dir).withColumnRenamed("customer_token", "pan")


def _ingest(spark, lake, tx, run_date) -> None:
    J.ingest(spark, lake, tx, None, run_date, token_key=O.TOKEN_KEY, salt=O.TOKEN_SALT)


# ------------------------------------------------------------ round trips --
@register(
    "raw_roundtrip",
    f"""WITH {O.raw_events()}
SELECT transaction_id, {O.hmac_sql('customer_token')} AS customer_token, amount, transaction_timestamp,
       DATE '{SECOND_RUN}' AS _ingestion_date, 'batch-{SECOND_RUN}' AS _batch_id, age, tenure_months
FROM (SELECT *, customer_age::INTEGER AS age FROM raw_tx) t SELECT_END"""
    .replace("tenure_months\nFROM", "t.tenure_months::INTEGER AS tenure_months\nFROM")
    .replace("SELECT_END", f"WHERE transaction_timestamp >= TIMESTAMP '{CUT} 00:00:00'"),
)
def raw_roundtrip(spark, sf_dir):
    """B6 + S1 + S6 + P2: two batches ingested, the second one read back."""
    lake, tx = new_lake(spark), _with_pan(spark, sf_dir)
    _ingest(spark, lake, tx.filter(F.col("transaction_timestamp") < CUT), FIRST_RUN)
    _ingest(spark, lake, tx.filter(F.col("transaction_timestamp") >= CUT), SECOND_RUN)
    bronze = L.bronze(J.raw_batch(spark, lake, SECOND_RUN), SECOND_RUN)
    return bronze.select(
        "transaction_id", "customer_token", "amount", "transaction_timestamp", "_ingestion_date", "_batch_id", "age", "tenure_months"
    )


@register(
    "rerun_batch",
    f"""WITH {O.raw_events()}
SELECT year(transaction_timestamp)::INTEGER AS year, month(transaction_timestamp)::INTEGER AS month,
       day(transaction_timestamp)::INTEGER AS day, count(*) AS rows, count(DISTINCT transaction_id) AS transactions
FROM raw_tx GROUP BY ALL""",
)
def rerun_batch(spark, sf_dir):
    """S6 + T3 + T4 + F17: a batch first written in part, then rerun whole;
    the rerun takes the place of its own rows and leaves the others."""
    lake, tx = new_lake(spark), _with_pan(spark, sf_dir)
    late = tx.filter(F.col("transaction_timestamp") >= CUT)
    _ingest(spark, lake, tx.filter(F.col("transaction_timestamp") < CUT), FIRST_RUN)
    _ingest(spark, lake, late.filter("transaction_id < 'txn_000005000'"), SECOND_RUN)
    _ingest(spark, lake, late, SECOND_RUN)
    raw = J.raw_transactions(spark, lake)
    by_day = raw.groupBy(*(F.col(c).cast("int").alias(c) for c in IO.PARTITION_COLUMNS))
    return by_day.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("transaction_id").alias("transactions"))


@register(
    "late_batch",
    f"""WITH {O.raw_events()}
SELECT transaction_id, {O.hmac_sql('customer_token')} AS customer_token,
       CASE WHEN n % 3 = 0 THEN amount + 1000 ELSE amount END AS amount, transaction_timestamp::DATE AS event_date,
       CASE WHEN n % 3 = 0 OR n % 5 = 0 THEN 'batch-{SECOND_RUN}' ELSE 'batch-{FIRST_RUN}' END AS _batch_id
FROM (SELECT *, substr(transaction_id, 5)::BIGINT AS n FROM raw_tx) t""",
)
def late_batch(spark, sf_dir):
    """B6 + S6 + W6: late events. The first batch lacks every fifth event; the
    second has them, for dates that the first one wrote, and corrects every
    third event. It is run twice, the first time with rows it then takes back,
    and the even days are compacted; the odd days are deduplicated on reading."""
    from propensia.operators.dedup import keep_last

    lake, tx = new_lake(spark), _with_pan(spark, sf_dir)
    n = F.substring("transaction_id", 5, 20).cast("long")
    corrected = tx.filter((n % 3 == 0) | (n % 5 == 0)).withColumn("amount", F.when(n % 3 == 0, F.col("amount") + 1000).otherwise(F.col("amount")))
    _ingest(spark, lake, tx.filter(n % 5 != 0), FIRST_RUN)
    _ingest(spark, lake, corrected.unionByName(tx.filter(n % 7 == 1)), SECOND_RUN)
    _ingest(spark, lake, corrected, SECOND_RUN)
    J.compact_raw(spark, lake, [_dt.date(2024, 1, d) for d in range(2, 31, 2)])
    raw = J.raw_transactions(spark, lake).drop(*IO.PARTITION_COLUMNS, "write")
    last = keep_last(raw, ["transaction_id"], ["_ingestion_date"])
    return last.select("transaction_id", "customer_token", "amount", F.to_date("transaction_timestamp").alias("event_date"), "_batch_id")


@register(
    "labels_roundtrip",
    f"""SELECT {O.hmac_sql(f'CAST({A.PAN_BASE} + c_custkey AS VARCHAR)')} AS customer_token,
       CASE WHEN c_acctbal > {A.ADOPTION_BALANCE} THEN 1 ELSE 0 END::INTEGER AS adopted_card FROM customer""",
)
def labels_roundtrip(spark, sf_dir):
    """S2 + S7 + W6: label batches of two runs written, read, last one kept."""
    lake, tx = new_lake(spark), _with_pan(spark, sf_dir).limit(0)
    labels = A.customer_as_labels(spark, sf_dir).withColumnRenamed("customer_token", "pan")
    for run_date in A.LABEL_BATCHES:
        own = labels.filter(F.col("_ingestion_date") == F.lit(run_date)).select("pan", "adopted_card", "age", "tenure_months")
        J.ingest(spark, lake, tx, own, run_date, token_key=O.TOKEN_KEY, salt=O.TOKEN_SALT)
    from propensia.operators.dedup import latest_labels

    return latest_labels(IO.read_raw_labels(spark, lake.raw_labels))


@register(
    "file_order",
    """SELECT c_custkey::VARCHAR AS customer_token, CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END::INTEGER AS adopted_card
FROM customer""",
)
def file_order(spark, sf_dir):
    """W6 + S4: labels of one run date in two files. Every customer is in the
    first file with 1, even ones in the second with 0, where every third
    customer comes once more, after that, with 1: the later row counts."""
    from propensia.operators.dedup import latest_labels
    from propensia.session import materialize

    key = F.col("c_custkey")
    given = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit(1).alias("adopted_card")),
        F.when(key % 2 == 0, F.struct(F.lit(1).alias("seq"), F.lit(0).alias("adopted_card"))),
        F.when(key % 3 == 0, F.struct(F.lit(2).alias("seq"), F.lit(1).alias("adopted_card"))),
    )
    rows = A.table(spark, sf_dir, "customer").select(key.cast("string").alias("customer_token"), F.explode(F.array_compact(given)).alias("g"))
    rows = materialize(rows.select("customer_token", "g.*", F.lit(FIRST_RUN).alias("_ingestion_date")), "labels")
    root = new_lake(spark).path("labels")
    dealt = rows.withColumn("late", F.col("seq") > 0).repartitionByRange(2, "late").sortWithinPartitions("late", "seq")
    IO.write_run_partition(dealt.drop("late", "seq"), root, FIRST_RUN)
    return latest_labels(IO.read_prefix(spark, root, positions=True))


SCORE_DATES = [_dt.date(2024, 1, 24), _dt.date(2024, 1, 31), _dt.date(2024, 2, 7)]


@register(
    "score_history_mart",
    O.events_layers()[:-1]
    + f""",
published AS (
  SELECT customer_token, {O.r6(O.linear_score_sql({'txn_count_30d': 0.04, 'age': 0.01}, -3.5), 9)} AS propensity_score,
         3 AS score_decile, 'EXCLUDE' AS campaign_segment, feature_date, 1 AS run
  FROM gold WHERE feature_date = DATE '2024-01-23'
  UNION ALL
  SELECT customer_token, {O.r6(O.linear_score_sql({'txn_count_30d': 0.04, 'age': 0.01}, -3.5), 9)}, 3, 'EXCLUDE', feature_date, 2
  FROM gold WHERE feature_date = DATE '2024-01-30' AND customer_token::HUGEINT % 3 <> 0
  UNION ALL
  SELECT 'stranger-' || customer_token, 0.5, 3, 'EXCLUDE', feature_date, 3 FROM gold WHERE feature_date = DATE '2024-01-30')
SELECT f.customer_token, p.propensity_score, p.score_decile::INTEGER AS score_decile, p.campaign_segment, f.feature_date
FROM features f JOIN published p USING (customer_token, feature_date)""",
)
def score_history_mart(spark, sf_dir):
    """S3 + S8 + B3 + B4 + J2: scores of three dates published to the lake; the
    snapshot has customers without a score, the scores tokens without a
    snapshot, and one date is not the snapshot's."""
    from propensia.operators.scoring import LinearScorer, predict

    gold = events_layers(spark, sf_dir)["gold"]
    scorer = LinearScorer({"txn_count_30d": 0.04, "age": 0.01}, -3.5)

    def scored(rows):
        out = predict(rows, scorer).select("customer_token", score9("propensity_score").alias("propensity_score"), "feature_date")
        return out.withColumn("score_decile", F.lit(3)).withColumn("campaign_segment", F.lit("EXCLUDE"))

    last = gold.filter("feature_date = DATE'2024-01-30'")
    strangers = scored(last).withColumn("customer_token", F.concat(F.lit("stranger-"), "customer_token")).withColumn("propensity_score", F.lit(0.5))
    lake = new_lake(spark)
    parts = [scored(gold.filter("feature_date = DATE'2024-01-23'")), scored(last.filter("CAST(customer_token AS DECIMAL(20, 0)) % 3 <> 0")), strangers]
    for run_date, rows in zip(SCORE_DATES, parts):
        IO.write_run_partition(rows, lake.scores, run_date)
    return L.mart(events_layers(spark, sf_dir)["features"], IO.read_scores(spark, lake.scores))


@register(
    "mixed_schema_prefix",
    "SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal > 0 END AS in_credit FROM customer",
)
def mixed_schema_prefix(spark, sf_dir):
    """S4 + T4: files with different columns under one prefix, read together."""
    c = A.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    root = new_lake(spark).path("mixed")
    IO.write_run_partition(c.filter("c_custkey % 2 = 1"), root, FIRST_RUN)
    IO.write_run_partition(c.filter("c_custkey % 2 = 0").withColumn("in_credit", F.col("c_acctbal") > 0), root, SECOND_RUN)
    return IO.read_prefix(spark, root, merge_schema=True).select("c_custkey", "c_acctbal", "in_credit")


@register(
    "text_dates",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE o_orderdate::DATE END AS feature_date
FROM orders""",
)
def text_dates(spark, sf_dir):
    """dates kept as text; empty, invalid and null ones become null."""
    from propensia.functions.expr import as_date_column

    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    spoiled = F.when(F.col("o_orderkey") % 5 == 1, "").when(F.col("o_orderkey") % 5 == 2, F.concat(text, F.lit("x")))
    spoiled = spoiled.when(F.col("o_orderkey") % 5 == 3, F.lit(None)).when(F.col("o_orderkey") % 5 == 4, F.concat(text, F.lit(" 10:30:00"))).otherwise(text)
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", spoiled.alias("feature_date"))
    return as_date_column(rows, "feature_date")


@register(
    "seed_csv",
    O.events_layers()
    + f"""SELECT p.merchant_mcc, p.transactions, p.rule_group, s.merchant_category_group AS seed_group,
       coalesce(p.rule_group = s.merchant_category_group, false) AS agrees
FROM (SELECT merchant_mcc, count(*) AS transactions, any_value(merchant_category_group) AS rule_group FROM silver GROUP BY merchant_mcc) p
LEFT JOIN (SELECT * FROM (VALUES {O.SEED_VALUES.replace("(5411, 'grocery_retail')", "(5411, 'other')").replace("(7999, 'other')", "(8999, 'other')")})
           s(merchant_mcc, merchant_category_group)) s ON p.merchant_mcc = s.merchant_mcc""",
)
def seed_csv(spark, sf_dir):
    """S5 + J6: the seed read from a CSV file in which one code disagrees with
    the rules and one is missing."""
    from propensia.sources.seed import read_seed_csv, seed_frame

    path = new_lake(spark).path("seed")
    changed = F.when(F.col("merchant_mcc") == 5411, "other").otherwise(F.col("merchant_category_group"))
    code = F.when(F.col("merchant_mcc") == 7999, 8999).otherwise(F.col("merchant_mcc"))
    seed = seed_frame(spark).select(code.alias("merchant_mcc"), changed.alias("merchant_category_group"))
    seed.write.option("header", True).csv(path)
    return L.mcc_seed_check(events_layers(spark, sf_dir)["silver"], read_seed_csv(spark, path))


@register(
    "transaction_attributes",
    """SELECT e.event_id, (21 + c_custkey % 50)::INTEGER AS age, (1 + c_custkey % 120)::INTEGER AS tenure_months
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id""",
)
def transaction_attributes(spark, sf_dir):
    """Customer attributes attached to every transaction by key."""
    from propensia.operators.behaviour import attach_customer_attributes

    tx = A.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("customer_token"))
    customers = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_token"),
        (F.lit(21) + F.col("c_custkey") % 50).cast("int").alias("age"),
        (F.lit(1) + F.col("c_custkey") % 120).cast("int").alias("tenure_months"),
    )
    return attach_customer_attributes(tx, customers).select("event_id", "age", "tenure_months")


# ---------------------------------------------------------- dense binding --
LINEITEM_RUN, LINEITEM_OTHER_RUN = _dt.date(2001, 8, 2), _dt.date(2001, 7, 26)


def _raw_lineitem() -> str:
    return f"""raw_tx AS (
  SELECT 'supplier-' || l_suppkey AS customer_token, 'txn_' || l_orderkey || '_' || l_linenumber AS transaction_id,
         floor(l_extendedprice) AS amount, CASE WHEN l_linenumber = 7 THEN 'EUR' ELSE 'USD' END AS currency,
         l_shipdate AS transaction_timestamp, CASE WHEN l_quantity > 25 THEN 'APP' ELSE 'branch' END AS channel,
         CASE WHEN l_linenumber % 2 = 0 THEN 'POS' ELSE 'refund' END AS transaction_type,
         5400 + (l_quantity::INTEGER % 30) * 21 AS merchant_mcc, l_linenumber = 1 AS is_cross_border,
         40 AS customer_age, 12 AS tenure_months,
         CASE WHEN l_linenumber = 4 THEN DATE '{LINEITEM_OTHER_RUN}' ELSE DATE '{LINEITEM_RUN}' END AS _ingestion_date,
         TIMESTAMP '{LINEITEM_RUN} 00:00:00' AS _ingestion_timestamp, 'batch-{LINEITEM_RUN}' AS _batch_id
  FROM lineitem)"""


def lineitem_as_transactions(spark, sf_dir) -> DataFrame:
    """``lineitem`` by supplier: dense days, unknown codes, types and currency,
    two batches; whole amounts, so that sums don't depend on their order."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "concat('supplier-', l_suppkey) AS customer_token",
        "concat('txn_', l_orderkey, '_', l_linenumber) AS transaction_id",
        "CAST(floor(l_extendedprice) AS DOUBLE) AS amount",
        "CASE WHEN l_linenumber = 7 THEN 'EUR' ELSE 'USD' END AS currency",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS transaction_timestamp",
        "CASE WHEN l_quantity > 25 THEN 'APP' ELSE 'branch' END AS channel",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'POS' ELSE 'refund' END AS transaction_type",
        "5400 + (CAST(l_quantity AS INT) % 30) * 21 AS merchant_mcc",
        "l_linenumber = 1 AS is_cross_border",
        "40 AS customer_age",
        "12 AS tenure_months",
        f"CASE WHEN l_linenumber = 4 THEN DATE'{LINEITEM_OTHER_RUN}' ELSE DATE'{LINEITEM_RUN}' END AS _ingestion_date",
        f"TIMESTAMP'{LINEITEM_RUN} 00:00:00' AS _ingestion_timestamp",
        f"'batch-{LINEITEM_RUN}' AS _batch_id",
    )


def _lineitem_gold(spark, sf_dir) -> DataFrame:
    return L.gold(L.daily_customer(L.silver(L.bronze(lineitem_as_transactions(spark, sf_dir), LINEITEM_RUN))))


@register("gold_lineitem", O.layers(_raw_lineitem(), LINEITEM_RUN.isoformat()) + O.GOLD_SELECT + " FROM gold")
def gold_lineitem(spark, sf_dir):
    """P2 + W1-W4: hundreds of active days a customer, so that 30 and 90 rows
    bite; the batch filter drops the lines of another run."""
    return rounded_gold(_lineitem_gold(spark, sf_dir))


@register(
    "split_lineitem",
    O.layers(_raw_lineitem(), LINEITEM_RUN.isoformat())[:-1]
    + """,
cut AS (SELECT max(feature_date) - 30 AS day FROM gold)
SELECT CASE WHEN feature_date <= day THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
       sum((substr(customer_token, 10)::INTEGER % 3 = 0)::INTEGER)::BIGINT AS positives
FROM gold, cut GROUP BY 1""",
)
def split_lineitem(spark, sf_dir):
    """P8 + P9 + A4 + A10: the guarded split with the default 30-day hold-out."""
    from propensia.operators.training import temporal_split
    from propensia.session import materialize

    label = (F.substring("customer_token", 10, 20).cast("int") % 3 == 0).cast("int")
    frame = materialize(_lineitem_gold(spark, sf_dir).select("customer_token", "feature_date", label.alias("adopted_card")), "split")
    train, test = temporal_split(frame)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("adopted_card").alias("positives"))


# ------------------------------------------------------------ weekly runs --
def _weekly_sql() -> str:
    from propensia.operators.scoring import DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT

    p = O.r6(O.linear_score_sql(DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT), 9)
    runs = []
    for run_date, kept in ((EARLY_RUN, "event_id % 3 = 0"), (SECOND_RUN, "true")):
        raw = O.raw_events().replace("FROM events)", f"FROM events WHERE {kept})").replace(A.EVENTS_RUN_DATE.isoformat(), run_date.isoformat())
        raw = raw.replace("raw_tx AS (", "raw_pan AS (", 1) + f", raw_tx AS (SELECT * REPLACE ({O.hmac_sql('customer_token')} AS customer_token) FROM raw_pan)"
        layers = O.layers(raw, run_date.isoformat()).rstrip()
        runs.append(
            f"""SELECT * FROM ({layers},
scored AS (SELECT customer_token, feature_date, {p} AS propensity_score FROM features),
ranked AS (SELECT *, row_number() OVER (ORDER BY propensity_score, customer_token) AS r, count(*) OVER () AS n FROM scored)
SELECT DATE '{run_date}' AS run_date, customer_token, propensity_score, {O.decile_sql('r', 'n')} AS score_decile,
       {O.campaign_sql(O.decile_sql('r', 'n'))} AS campaign_segment, feature_date::DATE AS feature_date FROM ranked)"""
        )
    return "\nUNION ALL\n".join(runs)


EARLY_RUN = _dt.date(2024, 1, 24)


class Interrupted(RuntimeError):
    pass


@register("weekly_run", _weekly_sql())
def weekly_run(spark, sf_dir):
    """B1 + B3 + B4 + B5 + B6: two weekly runs over a lake. The second takes in
    late events too, breaks off after gold and is called again; the marts of both."""
    from propensia.operators.scoring import LinearScorer

    class Rounded(LinearScorer):
        def transform(self, df):
            out = super().transform(df)
            return out.withColumn(self.output_col, score9(self.output_col))

    lake, tx = new_lake(spark), _with_pan(spark, sf_dir)

    def stop_before(stage):
        if stage == "features":
            raise Interrupted(stage)

    def run(run_date, rows, watch=None):
        return J.run_weekly(spark, lake, run_date, rows, None, O.TOKEN_KEY, O.TOKEN_SALT, gate=False, model=Rounded(), watch=watch)

    run(EARLY_RUN, tx.filter(F.substring("transaction_id", 5, 20).cast("long") % 3 == 0))
    try:
        run(SECOND_RUN, tx, stop_before)
    except Interrupted:
        ran = run(SECOND_RUN, tx)["stages"]
        if ran != ["features", "score", "mart"]:
            raise AssertionError(f"the run was not resumed where it stopped: {ran}") from None
    marts = IO.read_prefix(spark, lake.mart)
    return marts.select(IO.partition_date().alias("run_date"), "customer_token", "propensity_score", "score_decile", "campaign_segment", "feature_date")


#: Hold-out days of three training runs; the last run is recorded twice.
METRIC_RUNS = {FIRST_RUN: 6, EARLY_RUN: 8, SECOND_RUN: 10}


def _run_metrics_sql() -> str:
    runs = [
        f"SELECT DATE '{d}' AS run_date, {1 + (d == SECOND_RUN)}::INTEGER AS version, * FROM ({metrics_sql(days)})"
        for d, days in METRIC_RUNS.items()
    ]
    return "\nUNION ALL\n".join(runs)


@register("run_metrics", _run_metrics_sql())
def run_metrics(spark, sf_dir):
    """The history of three runs' metrics, recorded at the same time after a
    first, wrong record of the last run; the newest version of each run."""
    from concurrent.futures import ThreadPoolExecutor

    from propensia.session import materialize

    frame = materialize(training_inputs(spark, sf_dir), "runs")
    root = new_lake(spark).metrics
    IO.write_metrics(holdout_metrics(frame, METRIC_RUNS[FIRST_RUN]), root, SECOND_RUN)
    with ThreadPoolExecutor(len(METRIC_RUNS)) as pool:
        list(pool.map(lambda run: IO.write_metrics(holdout_metrics(frame, run[1]), root, run[0]), METRIC_RUNS.items()))
    return IO.read_metrics(spark, root, latest=True).drop("recorded_at")


# ----------------------------------------------------------------- stream --
@register("request_stream", request_sql())
def request_stream(spark, sf_dir):
    """R1 as a stream: arrivals of two deliveries, the second with requests of
    the first sent again. The stream stops after the first one and goes on from
    its checkpoint; every request is answered once, as in ``request_scoring``."""
    from propensia.operators.scoring import LinearScorer
    from propensia.session import materialize
    from propensia.streaming.requests import read_responses, serve_requests

    root = new_lake(spark)
    source, responses, checkpoint = (root.path("requests", p) for p in ("arrivals", "responses", "checkpoint"))
    n = F.substring("request_id", 10, 10).cast("long")
    second = F.pmod(F.xxhash64("request_id"), F.lit(1800))
    bodies = request_bodies(events_layers(spark, sf_dir)["features"]).withColumn("received_at", F.timestamp_seconds(F.lit(1706659200) + second))
    bodies = materialize(bodies, "arrivals")
    first = bodies.filter(n % 3 < 2)
    again = first.filter(n % 2 == 0).withColumn("received_at", F.col("received_at") + F.expr("INTERVAL 10 MINUTES"))
    for delivery in (first.unionByName(first.filter(n % 5 == 0)), bodies.filter(n % 3 == 2).unionByName(again)):
        delivery.write.mode("append").parquet(source)
        serve_requests(spark, source, LinearScorer(), responses, checkpoint, fmt="parquet")
    return read_responses(spark, responses).drop("epoch", "received_at")


# ---------------------------------------------------------------- windows --
@register(
    "rolling_window",
    """SELECT l_orderkey, l_linenumber, key, sum(l_quantity) OVER (w ROWS 6 PRECEDING) AS quantity_7,
       sum(l_quantity) OVER (w ROWS 44 PRECEDING) AS quantity_45, sum(l_linenumber) OVER (w ROWS 0 PRECEDING)::BIGINT AS line_1
FROM (SELECT *, CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey END AS key FROM lineitem)
WINDOW w AS (PARTITION BY key ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice)""",
)
def rolling_window_lineitem(spark, sf_dir):
    """Sums over the last 7, 45 and 1 rows of each key; the null key holds a third of all rows."""
    from propensia.operators.windows import rolling_window

    rows = A.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_suppkey")).alias("key"), "l_shipdate", "l_partkey",
        "l_extendedprice", "l_quantity",
    )
    sums = {"quantity_7": ("l_quantity", 7), "quantity_45": ("l_quantity", 45), "line_1": ("l_linenumber", 1)}
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return rolling_window(rows, sums, ["key"], order).drop("l_shipdate", "l_partkey", "l_extendedprice", "l_quantity")


@register(
    "merchant_diversity",
    O.layers(_raw_lineitem(), LINEITEM_RUN.isoformat())[:-1]
    + """
SELECT d.customer_token, d.feature_date, count(DISTINCT s.merchant_mcc) AS merchants_30d
FROM (SELECT DISTINCT customer_token, transaction_date AS feature_date FROM silver) d
LEFT JOIN silver s ON s.customer_token = d.customer_token AND date_diff('day', s.transaction_date, d.feature_date) BETWEEN 0 AND 29
GROUP BY ALL""",
)
def merchant_diversity(spark, sf_dir):
    """A3 + J3: distinct merchant codes, an open domain, in 30 calendar days."""
    from propensia.operators.windows import sliding_distinct

    silver = L.silver(L.bronze(lineitem_as_transactions(spark, sf_dir), LINEITEM_RUN))
    rows = silver.withColumnRenamed("transaction_date", "feature_date")
    return sliding_distinct(rows, "customer_token", "feature_date", "merchant_mcc", 30, "merchants_30d")


# ----------------------------------------------------------------- guards --
@register(
    "guard_report",
    O.events_layers()[:-1] + O.labels_cte() + O.history_cte()
    + """
SELECT 'labels of one class' AS input, (SELECT count(DISTINCT adopted_card) <> 2 FROM training WHERE adopted_card = 0) AS stopped
UNION ALL SELECT 'labels of two classes', (SELECT count(DISTINCT adopted_card) <> 2 FROM training)
UNION ALL SELECT 'no rows before the cutoff', (SELECT count(*) FILTER (feature_date <= (SELECT max(feature_date) FROM training) - 400) = 0 FROM training)
UNION ALL SELECT 'score missing', (SELECT count(*) FILTER (volume_90d IS NULL) > 0 FROM (SELECT CASE WHEN age % 7 = 0 THEN NULL ELSE age END AS volume_90d FROM training))
UNION ALL SELECT 'no scored rows', (SELECT count(*) = 0 FROM training WHERE age < 0)
UNION ALL SELECT 'non-positive amounts', (SELECT count(*) FILTER (amount IS NULL OR amount <= 0) > 0 FROM bronze)
UNION ALL SELECT 'valid amounts', (SELECT count(*) FILTER (amount IS NULL OR amount <= 0) > 0 FROM silver)
UNION ALL SELECT 'feature column missing', true""",
)
def guard_report(spark, sf_dir):
    """P6 + P8 + M6 + Q8: which guard stops which input."""
    from propensia import schemas as S
    from propensia.operators import quality as Q
    from propensia.operators.metrics import evaluation_metrics
    from propensia.operators.scoring import check_columns
    from propensia.operators.training import require_classes, temporal_split
    from propensia.session import materialize

    frame = materialize(training_inputs(spark, sf_dir), "guards")
    layers = events_layers(spark, sf_dir)
    scored = frame.withColumn("propensity_score", F.lit(0.5))
    cases = {
        "labels of one class": lambda: require_classes(frame.filter("adopted_card = 0")),
        "labels of two classes": lambda: require_classes(frame),
        "no rows before the cutoff": lambda: temporal_split(frame, 400),
        "score missing": lambda: evaluation_metrics(scored.withColumn("propensity_score", F.when(F.col("age") % 7 != 0, 0.5))),
        "no scored rows": lambda: evaluation_metrics(scored.filter("age < 0")),
        "non-positive amounts": lambda: Q.assert_passing(Q.quality_report(layers["bronze"], [Q.positive("amount")], "bronze")),
        "valid amounts": lambda: Q.assert_passing(Q.quality_report(layers["silver"], [Q.positive("amount")], "silver")),
        "feature column missing": lambda: check_columns(frame.drop("age"), list(S.FEATURE_COLUMNS)),
    }
    rows = []
    for name, run in cases.items():
        try:
            run()
            rows.append((name, False))
        except (ValueError, Q.QualityGateError):
            rows.append((name, True))
    return spark.createDataFrame(rows, "input string, stopped boolean")
