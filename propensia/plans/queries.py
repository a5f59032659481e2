"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables through the bindings in
``propensia.sources.adapters`` and runs the library operators over the
whole tables. Doubles are rounded in the final select only (for the
oracle compare; never inside a step). ``ORACLE`` holds the DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions import expr as X
from propensia.functions.tokenize import stable_customer_token
from propensia.operators import layers as L
from propensia.plans import oracle as O
from propensia.session import ensure_conf
from propensia.sources import adapters as A
from propensia.sources.seed import seed_frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def round_half_away(c, places: int = 6):
    """Rounding of compared doubles; a half keeps clear of the order of a sum."""
    return X.round_half_away(c, places, slack=1e-7)


# ------------------------------------------------------------- bindings --
class _Layers(dict):
    """Layers of one run, each built on first use (and only once)."""

    def __init__(self, raw_fn, run_date):
        super().__init__()
        self._raw_fn, self._run_date = raw_fn, run_date

    def __missing__(self, name):
        if name == "bronze":
            value = L.bronze(self._raw_fn(), self._run_date)
        elif name == "silver":
            value = L.silver(self["bronze"])
        elif name == "gold":
            value = L.gold(L.daily_customer(self["silver"]))
        elif name == "features":
            value = L.features(self["gold"], self._run_date)
        else:
            raise KeyError(name)
        self[name] = value
        return value


def events_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Layers(lambda: A.events_as_transactions(spark, sf_dir), A.EVENTS_RUN_DATE)


def orders_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Layers(lambda: A.orders_as_transactions(spark, sf_dir), A.ORDERS_RUN_DATE)


def rounded_gold(g: DataFrame) -> DataFrame:
    cols = []
    for c in g.columns:
        if c in ("volume_7d", "volume_30d", "volume_90d", "avg_txn_size_30d", "digital_ratio_30d"):
            cols.append(round_half_away(c, 6).alias(c))
        else:
            cols.append(F.col(c))
    return g.select(*cols)


# --------------------------------------------------------------- layers --
@register(
    "tokenize_customers",
    f"SELECT c_custkey, {O.hmac_sql(f'CAST({A.PAN_BASE} + c_custkey AS VARCHAR)')} AS customer_token FROM customer",
)
def tokenize_customers(spark, sf_dir):
    """HMAC-SHA256 token per customer PAN; the PAN is not returned."""
    c = A.table(spark, sf_dir, "customer")
    return c.select("c_custkey", stable_customer_token(A.pan_of(F.col("c_custkey")), O.TOKEN_KEY, O.TOKEN_SALT).alias("customer_token"))


@register("bronze_transactions", O.events_layers() + "SELECT * FROM bronze")
def bronze_transactions(spark, sf_dir):
    """P1 + P2 over the events batch."""
    return events_layers(spark, sf_dir)["bronze"]


@register(
    "silver_transactions",
    O.events_layers() + f"SELECT * EXCLUDE (amount_usd), {O.r6('amount_usd')} AS amount_usd FROM silver",
)
def silver_transactions(spark, sf_dir):
    """P3 + F1-F5 over the events batch."""
    s = events_layers(spark, sf_dir)["silver"]
    return s.withColumn("amount_usd", round_half_away("amount_usd", 6))


@register(
    "mcc_seed_check",
    O.events_layers()
    + f"""SELECT p.merchant_mcc, p.transactions, p.rule_group, s.merchant_category_group AS seed_group,
       coalesce(p.rule_group = s.merchant_category_group, false) AS agrees
FROM (SELECT merchant_mcc, count(*) AS transactions, any_value(merchant_category_group) AS rule_group
      FROM silver GROUP BY merchant_mcc) p
LEFT JOIN (VALUES {O.SEED_VALUES}) s(merchant_mcc, merchant_category_group) ON p.merchant_mcc = s.merchant_mcc""",
)
def mcc_seed_check(spark, sf_dir):
    """S5 + J6 + F4: rule groups vs the seed for every MCC in silver."""
    return L.mcc_seed_check(events_layers(spark, sf_dir)["silver"], seed_frame(spark))


@register(
    "daily_customer",
    O.events_layers()
    + f"""SELECT customer_token, feature_date, CAST(daily_txn_count AS BIGINT) AS daily_txn_count,
       {O.r6('daily_volume_usd')} AS daily_volume_usd,
       CAST(daily_digital_count AS BIGINT) AS daily_digital_count,
       CAST(daily_cross_border_count AS BIGINT) AS daily_cross_border_count,
       {O.r6('daily_avg_txn_size')} AS daily_avg_txn_size, age, tenure_months FROM daily""",
)
def daily_customer(spark, sf_dir):
    """A1 + A2: the customer-day grain."""
    d = L.daily_customer(events_layers(spark, sf_dir)["silver"])
    return d.select(
        "customer_token",
        "feature_date",
        "daily_txn_count",
        round_half_away("daily_volume_usd", 6).alias("daily_volume_usd"),
        "daily_digital_count",
        "daily_cross_border_count",
        round_half_away("daily_avg_txn_size", 6).alias("daily_avg_txn_size"),
        "age",
        "tenure_months",
    )


@register("gold_customer_features", O.events_layers() + O.GOLD_SELECT + " FROM gold")
def gold_customer_features(spark, sf_dir):
    """W1-W4, A3, J3, F8 over the events batch (dense days)."""
    return rounded_gold(events_layers(spark, sf_dir)["gold"])


@register("gold_orders", O.orders_layers() + O.GOLD_SELECT + " FROM gold")
def gold_orders(spark, sf_dir):
    """The gold layer on sparse days, where row and calendar frames differ."""
    return rounded_gold(orders_layers(spark, sf_dir)["gold"])


@register("features_snapshot", O.events_layers() + O.GOLD_SELECT + ", engagement_segment FROM features")
def features_snapshot(spark, sf_dir):
    """P4 + F6: the scoring snapshot of the run (flagship query)."""
    return rounded_gold(events_layers(spark, sf_dir)["features"])


@register(
    "engagement_distribution",
    O.events_layers()
    + f"""SELECT engagement_segment, count(*) AS customers_days, {O.r6('avg(txn_count_30d)')} AS avg_txn_count_30d
FROM (SELECT CASE WHEN txn_count_30d >= 20 AND digital_ratio_30d >= 0.7 THEN 'power_digital'
                  WHEN txn_count_30d >= 10 AND digital_ratio_30d >= 0.4 THEN 'active_digital'
                  WHEN txn_count_30d >= 5 THEN 'casual' ELSE 'dormant' END AS engagement_segment, txn_count_30d
      FROM gold) GROUP BY engagement_segment""",
)
def engagement_distribution(spark, sf_dir):
    """F6 over every gold row, counted per segment."""
    from propensia.functions.expr import engagement_segment

    g = events_layers(spark, sf_dir)["gold"]
    seg = g.select(engagement_segment("txn_count_30d", "digital_ratio_30d").alias("engagement_segment"), "txn_count_30d")
    return seg.groupBy("engagement_segment").agg(
        F.count(F.lit(1)).alias("customers_days"), round_half_away(F.avg("txn_count_30d"), 6).alias("avg_txn_count_30d")
    )


# ------------------------------------------------------ training inputs --
HOLDOUT_DAYS_EVENTS = 10  # only 30 days of events exist (FIXTURES binding)


def training_inputs(spark, sf_dir, check_classes: bool = True):
    from propensia.operators.training import prepare_training_frame

    gold = events_layers(spark, sf_dir)["gold"]
    labels = A.customer_as_labels(spark, sf_dir)
    return prepare_training_frame(A.feature_history(gold), labels, check_classes=check_classes)


def score9(c):
    """Scores are compared (and ranked, in checked queries) at 9 places:
    ``exp`` may differ in the last bit between engines."""
    return round_half_away(c, 9)


@register("labels_latest", "WITH " + O.labels_cte()[2:] + " SELECT * FROM labels_latest")
def labels_latest(spark, sf_dir):
    """W6 + T1: last label per customer by ingestion date."""
    from propensia.operators.dedup import latest_labels

    return latest_labels(A.customer_as_labels(spark, sf_dir))


@register(
    "feature_history_latest",
    O.events_layers()[:-1] + O.history_cte().split(",\ntraining AS")[0] + "\n" + O.GOLD_SELECT + " FROM history_latest",
)
def feature_history_latest(spark, sf_dir):
    """Overlapping gold snapshots, last version per (token, date)."""
    from propensia.operators.dedup import latest_feature_rows

    gold = events_layers(spark, sf_dir)["gold"]
    return rounded_gold(latest_feature_rows(A.feature_history(gold)).drop("year", "month", "day"))


@register(
    "training_frame",
    O.events_layers()[:-1] + O.labels_cte() + O.history_cte()
    + f"""
SELECT customer_token, feature_date, recency_days, txn_count_30d, {O.r6('volume_30d')} AS volume_30d,
       {O.r6('digital_ratio_30d')} AS digital_ratio_30d, cross_border_count_90d, age, tenure_months, adopted_card FROM training""",
)
def training_frame(spark, sf_dir):
    """ML1 + J1 + P7: deduped history joined to deduped labels."""
    return rounded_gold(training_inputs(spark, sf_dir).drop("year", "month", "day"))


@register(
    "temporal_split",
    O.events_layers()[:-1] + O.labels_cte() + O.history_cte() + O.split_cte(HOLDOUT_DAYS_EVENTS)
    + "\nSELECT customer_token, feature_date, adopted_card, split FROM split",
)
def temporal_split(spark, sf_dir):
    """P9 + A4: train <= max(feature_date) - holdout < test."""
    from propensia.operators.training import label_split

    f = label_split(training_inputs(spark, sf_dir), HOLDOUT_DAYS_EVENTS)
    return f.select("customer_token", "feature_date", "adopted_card", "split")


@register(
    "class_weight",
    O.events_layers()[:-1] + O.labels_cte() + O.history_cte() + O.split_cte(HOLDOUT_DAYS_EVENTS)
    + f"""
SELECT CAST(sum(adopted_card) AS BIGINT) AS positives, CAST(count(*) - sum(adopted_card) AS BIGINT) AS negatives,
       {O.r6('CAST(count(*) - sum(adopted_card) AS DOUBLE) / nullif(CAST(sum(adopted_card) AS DOUBLE), 0)')} AS scale_pos_weight
FROM split WHERE split = 'train'""",
)
def class_weight(spark, sf_dir):
    """Class counts and positive weight of the training split."""
    from propensia.operators.training import class_weight as cw
    from propensia.operators.training import label_split

    train = label_split(training_inputs(spark, sf_dir), HOLDOUT_DAYS_EVENTS).filter(F.col("split") == "train")
    w = cw(train)
    return w.select("positives", "negatives", round_half_away("scale_pos_weight", 6).alias("scale_pos_weight"))


@register(
    "latest_snapshot",
    O.events_layers()[:-1] + O.history_cte().split(",\ntraining AS")[0]
    + """,
snap AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_token ORDER BY year DESC, month DESC, day DESC) AS rn
    FROM history WHERE feature_date = (SELECT max(feature_date) FROM history)) WHERE rn = 1)
"""
    + O.GOLD_SELECT + " FROM snap",
)
def latest_snapshot(spark, sf_dir):
    """P5 + W6: rows at the newest feature date, last run's version per customer."""
    from propensia.operators.scoring import latest_snapshot as latest

    gold = events_layers(spark, sf_dir)["gold"]
    return rounded_gold(latest(A.feature_history(gold)).drop("year", "month", "day"))


# ------------------------------------------------------------ behaviour --
def behaviour_frame(spark, sf_dir):
    from propensia.operators.behaviour import behaviour_index, customer_totals

    c = A.table(spark, sf_dir, "customer")
    domain = c.select(
        A.pan_of(F.col("c_custkey")).alias("customer_token"),
        (F.lit(21) + F.col("c_custkey") % 50).alias("age"),
        (F.lit(1) + F.col("c_custkey") % 120).alias("tenure_months"),
    )
    return behaviour_index(customer_totals(domain, events_layers(spark, sf_dir)["silver"]))


@register(
    "behaviour_index",
    O.events_layers()[:-1] + O.behaviour_cte()
    + f"""
SELECT customer_token, age, tenure_months, txn_count, digital_count, cross_border_count,
       {O.r6('volume_usd')} AS volume_usd, {O.r6('digital_ratio')} AS digital_ratio,
       {O.r6('propensity_signal', 9)} AS propensity_signal, {O.r6('adoption_probability', 9)} AS adoption_probability
FROM behaviour""",
)
def behaviour_index(spark, sf_dir):
    """A5 + A6 + J4 + J5 + F10 + F11 over the full customer domain."""
    b = behaviour_frame(spark, sf_dir)
    return b.select(
        "customer_token",
        "age",
        "tenure_months",
        "txn_count",
        "digital_count",
        "cross_border_count",
        round_half_away("volume_usd", 6).alias("volume_usd"),
        round_half_away("digital_ratio", 6).alias("digital_ratio"),
        round_half_away("propensity_signal", 9).alias("propensity_signal"),
        round_half_away("adoption_probability", 9).alias("adoption_probability"),
    )


@register(
    "score_deciles",
    O.events_layers()[:-1] + O.behaviour_cte()
    + f""",
ranked AS (
  SELECT customer_token, {O.r6('adoption_probability', 9)} AS propensity_score,
         row_number() OVER (ORDER BY {O.r6('adoption_probability', 9)}, customer_token) AS r, count(*) OVER () AS n
  FROM behaviour)
SELECT customer_token, propensity_score, {O.decile_sql('r', 'n')} AS score_decile,
       {O.campaign_sql(O.decile_sql('r', 'n'))} AS campaign_segment FROM ranked""",
)
def score_deciles(spark, sf_dir):
    """W5 + W7 + F7: relative deciles of the behaviour index (global rank)."""
    from propensia.functions.expr import campaign_segment
    from propensia.operators.ranking import assign_deciles

    b = behaviour_frame(spark, sf_dir).select("customer_token", score9("adoption_probability").alias("propensity_score"))
    d = assign_deciles(b, "propensity_score", ["customer_token"])
    return d.select("customer_token", "propensity_score", "score_decile", campaign_segment("score_decile").alias("campaign_segment"))


# -------------------------------------------------------------- scoring --
def snapshot_scores(snap):
    from propensia.operators.scoring import LinearScorer, predict, to_score_contract

    scored = predict(snap, LinearScorer()).withColumn("propensity_score", score9("propensity_score"))
    return snap, to_score_contract(scored, ["customer_token"])


def _scored_snapshot_sql() -> str:
    from propensia.operators.scoring import DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT

    p = O.r6(O.linear_score_sql(DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT), 9)
    return f""",
scored AS (
  SELECT customer_token, feature_date, {p} AS propensity_score FROM features),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY propensity_score, customer_token) AS r, count(*) OVER () AS n FROM scored),
scores AS (
  SELECT customer_token, propensity_score, {O.decile_sql('r', 'n')} AS score_decile,
         {O.campaign_sql(O.decile_sql('r', 'n'))} AS campaign_segment, CAST(feature_date AS DATE) AS feature_date
  FROM ranked)"""


@register("campaign_segments", O.events_layers()[:-1] + _scored_snapshot_sql() + "\nSELECT * FROM scores")
def campaign_segments(spark, sf_dir):
    """ML4 + W5 + W7 + F7 + P12: the 5-column score contract of the snapshot."""
    return snapshot_scores(events_layers(spark, sf_dir)["features"])[1]


@register(
    "segment_distribution",
    O.events_layers()[:-1] + _scored_snapshot_sql()
    + f"\nSELECT campaign_segment, count(*) AS customers, {O.r6('avg(propensity_score)', 9)} AS avg_score FROM scores GROUP BY campaign_segment",
)
def segment_distribution(spark, sf_dir):
    """Run summary per campaign segment."""
    from propensia.operators.metrics import segment_distribution as dist

    d = dist(snapshot_scores(events_layers(spark, sf_dir)["features"])[1])
    return d.select("campaign_segment", "customers", round_half_away("avg_score", 9).alias("avg_score"))


@register(
    "campaign_mart",
    O.events_layers()[:-1] + _scored_snapshot_sql()
    + """
SELECT f.customer_token, s.propensity_score, s.score_decile, s.campaign_segment, f.feature_date
FROM (SELECT customer_token, feature_date FROM features) f
JOIN scores s ON f.customer_token = s.customer_token AND f.feature_date = s.feature_date""",
)
def campaign_mart(spark, sf_dir):
    """J2 + P12: snapshot customers joined to their scores."""
    snap, scores = snapshot_scores(events_layers(spark, sf_dir)["features"])
    return L.mart(snap, scores)


# -------------------------------------------------------------- metrics --
def metrics_sql(holdout_days: int) -> str:
    from propensia.operators.scoring import DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT

    p = O.r6(O.linear_score_sql(DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT), 9)
    r = O.r6
    return (
        O.events_layers()[:-1] + O.labels_cte() + O.history_cte() + O.split_cte(holdout_days)
        + f""",
test AS (SELECT customer_token, feature_date, adopted_card AS y, {p} AS p FROM split WHERE split = 'test'),
tot AS (SELECT count(*) AS n, CAST(sum(y) AS DOUBLE) AS pos, avg(CAST(y AS DOUBLE)) AS prevalence,
               avg(power(p - y, 2)) AS brier FROM test),
per AS (SELECT p, count(*) AS c, sum(y) AS pos FROM test GROUP BY p),
cum AS (SELECT *, sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(c) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM per),
curve AS (SELECT sum(pos * tp / seen) AS ap_num, sum((c - pos) * (tp - pos / 2.0)) AS auc_num FROM cum),
top AS (SELECT avg(CAST(y AS DOUBLE)) AS precision_at_10 FROM (
          SELECT y, row_number() OVER (ORDER BY p DESC, customer_token DESC, feature_date DESC) AS rk FROM test)
        WHERE rk <= (SELECT greatest(1, CAST(ceil(CAST(0.1 AS DOUBLE) * n) AS BIGINT)) FROM tot))
SELECT CAST(tot.n AS BIGINT) AS n, CAST(tot.pos AS BIGINT) AS positives, {r('tot.prevalence')} AS prevalence,
       {r('CASE WHEN tot.pos > 0 THEN (SELECT ap_num FROM curve) / tot.pos ELSE 0.0 END')} AS pr_auc,
       {r('(SELECT auc_num FROM curve) / (tot.pos * (tot.n - tot.pos))')} AS roc_auc,
       {r('(SELECT precision_at_10 FROM top)')} AS precision_at_10,
       {r('CASE WHEN tot.prevalence > 0 THEN (SELECT precision_at_10 FROM top) / tot.prevalence ELSE 0.0 END')} AS lift_at_10,
       {r('tot.brier')} AS brier_score
FROM tot"""
    )


@register("evaluation_metrics", metrics_sql(HOLDOUT_DAYS_EVENTS))
def evaluation_metrics(spark, sf_dir):
    """M1-M6 + T2 + A8 on the hold-out split (deterministic scorer)."""
    return holdout_metrics(training_inputs(spark, sf_dir), HOLDOUT_DAYS_EVENTS)


def holdout_metrics(frame: DataFrame, holdout_days: int) -> DataFrame:
    """Metrics of the deterministic scorer on the last days of a training frame."""
    from propensia.operators.metrics import evaluation_metrics as em
    from propensia.operators.scoring import LinearScorer, predict
    from propensia.operators.training import label_split

    test = label_split(frame, holdout_days).filter(F.col("split") == "test")
    scored = predict(test, LinearScorer()).withColumn("propensity_score", score9("propensity_score"))
    m = em(scored, "adopted_card", "propensity_score", ["customer_token", "feature_date"])
    return m.select(
        "n",
        "positives",
        *[round_half_away(c, 6).alias(c) for c in ["prevalence", "pr_auc", "roc_auc", "precision_at_10", "lift_at_10", "brier_score"]],
    )


# ------------------------------------------------------------- requests --
REQUEST_VARIANTS = 13  # request shape chosen by customer id % 10 (see below)


def request_bodies(snap):
    """FIXTURES 3.5: JSON bodies from the snapshot with public field names,
    spoiled by customer id: 0 and 12 valid, 1 no age, 2 age true, 3 age "x",
    4 age null, 5 ratio 1.5, 6 invalid JSON, 7 JSON array, 8 JSON number,
    9 age twice (first "x"), 10 JSON string, 11 array that names all fields."""
    kind = f"CAST((CAST(customer_token AS DECIMAL(20, 0)) - {A.PAN_BASE}) % {REQUEST_VARIANTS} AS INT)"
    fields = []
    for api, model in S.MODEL_INPUT_MAP.items():
        value = f"coalesce(CAST({model} AS STRING), 'null')"
        if api == "age":
            value = f"""CASE WHEN {kind} = 2 THEN 'true' WHEN {kind} = 3 THEN '"x"' WHEN {kind} = 4 THEN 'null' ELSE {value} END"""
        if api == "digital_ratio_30d":
            value = f"CASE WHEN {kind} = 5 THEN '1.5' ELSE {value} END"
        text = f"""concat('"{api}": ', {value})"""
        if api == "age":
            text = f"CASE WHEN {kind} = 1 THEN NULL ELSE {text} END"
        fields.append(text)
    obj = "concat('{', concat_ws(', ', " + ", ".join(fields) + "), '}')"
    every = "[" + ", ".join(f'"{f}"' for f in S.REQUEST_FIELDS) + "]"
    twice = f"""concat('{{"age": "x", ', substring({obj}, 2))"""
    body = f"""CASE {kind} WHEN 6 THEN '{{"recency_days": 1,' WHEN 7 THEN '["age", 1]' WHEN 8 THEN '42' WHEN 9 THEN {twice}
        WHEN 10 THEN '"age"' WHEN 11 THEN '{every}' ELSE {obj} END"""
    return snap.selectExpr("customer_token AS request_id", f"{body} AS body")


def request_sql() -> str:
    """The validation rules over (request, field) rows.

    A field of an object is a key (of a repeated key the last value, which is
    how the text of kind 9 reads without its first ``age``), of an array a
    string element, of a string none.
    """
    from propensia.operators.scoring import DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT

    columns = {  # request field: model feature
        "age": "age", "cross_border_count_90d": "cross_border_count_90d", "digital_ratio_30d": "digital_ratio_30d",
        "frequency_30d": "txn_count_30d", "monetary_30d": "volume_30d", "recency_days": "recency_days", "tenure_months": "tenure_months",
    }
    spoiled = {
        "age": "CASE k WHEN 1 THEN NULL WHEN 2 THEN 'true' WHEN 3 THEN '\"x\"' WHEN 4 THEN 'null' ELSE {v} END",
        "digital_ratio_30d": "CASE k WHEN 5 THEN '1.5' ELSE {v} END",
    }
    parts = [
        "'\"" + api + "\": ' || " + spoiled.get(api, "{v}").format(v=f"coalesce({model}::VARCHAR, 'null')") for api, model in columns.items()
    ]
    names = ", ".join(f"'{f}'" for f in columns)
    every = ", ".join('"' + f + '"' for f in columns)
    score = O.linear_score_sql(DEFAULT_COEFFICIENTS, DEFAULT_INTERCEPT, prefix="v_")
    values = ", ".join(f"max(num) FILTER (field = '{api}') AS v_{model}" for api, model in columns.items())
    return (
        O.events_layers()[:-1]
        + f""",
req AS (
  SELECT customer_token AS request_id, CASE k WHEN 6 THEN '{{"recency_days": 1,' WHEN 7 THEN '["age", 1]' WHEN 8 THEN '42'
         WHEN 10 THEN '"age"' WHEN 11 THEN '[{every}]' ELSE '{{' || concat_ws(', ', {', '.join(parts)}) || '}}' END AS body
  FROM (SELECT *, ((customer_token::HUGEINT - {A.PAN_BASE}) % {REQUEST_VARIANTS})::INTEGER AS k FROM features)),
kinds AS (SELECT *, CASE WHEN json_valid(body) THEN json_type(body) END AS top FROM req),
asked AS (
  SELECT request_id, top, field,
         CASE top WHEN 'OBJECT' THEN json_exists(body, '$.' || field) WHEN 'ARRAY' THEN list_contains(json_extract_string(body, '$[*]'), field)
                  WHEN 'VARCHAR' THEN false ELSE true END AS given,
         CASE WHEN top = 'OBJECT' THEN coalesce(json_type(body, '$.' || field) IN ('BIGINT', 'UBIGINT', 'DOUBLE'), false) END AS numeric,
         CASE WHEN top = 'OBJECT' THEN TRY_CAST(json_extract_string(body, '$.' || field) AS DOUBLE) END AS num
  FROM kinds, (SELECT unnest([{names}]) AS field)),
rules AS (
  SELECT request_id, any_value(top) AS top, string_agg(field, ', ' ORDER BY field) FILTER (NOT given) AS absent,
         string_agg(field, ', ' ORDER BY field) FILTER (given AND NOT numeric) AS wrong, {values}
  FROM asked GROUP BY request_id),
checked AS (
  SELECT *, CASE WHEN top IS NULL THEN 'Request body must be valid JSON.'
                 WHEN absent IS NOT NULL THEN 'Missing required fields: ' || absent
                 WHEN top <> 'OBJECT' THEN 'Request body must be a JSON object.'
                 WHEN wrong IS NOT NULL THEN 'Fields must be numeric: ' || wrong
                 WHEN NOT v_digital_ratio_30d BETWEEN 0 AND 1 THEN 'digital_ratio_30d must be between 0 and 1.' END AS error
  FROM rules),
good AS (SELECT *, CASE WHEN error IS NULL THEN {score} END AS p FROM checked),
graded AS (SELECT *, least(10, greatest(1, ceil(p * 10)))::INTEGER AS d FROM good WHERE p IS NOT NULL)
SELECT c.request_id, CASE WHEN c.error IS NULL THEN 200 ELSE 400 END AS status, c.error,
       printf('%.4f', g.p)::DOUBLE AS propensity_score, g.d AS score_decile, {O.campaign_sql('g.d')} AS recommendation,
       printf('%.1fx', g.p / 0.03) AS expected_lift
FROM checked c LEFT JOIN graded g ON c.request_id = g.request_id"""
    )


@register("request_scoring", request_sql())
def request_scoring(spark, sf_dir):
    """R1 + F12-F14 + F16: validate and score JSON requests built from the snapshot."""
    from propensia.operators.scoring import LinearScorer
    from propensia.streaming.requests import score_requests

    bodies = request_bodies(events_layers(spark, sf_dir)["features"])
    return score_requests(bodies, LinearScorer()).drop("body")


# -------------------------------------------------------------- quality --
def _quality_suites():
    from propensia.operators import quality as Q

    return [
        ("bronze", Q.bronze_checks()),
        ("silver", Q.silver_checks()),
        ("gold", Q.gold_checks(as_of=A.EVENTS_RUN_DATE)),
        ("features", Q.features_checks()),
        ("mart", Q.mart_checks()),
    ]


def _quality_report_sql() -> str:
    from propensia.operators.quality import quality_sql

    mart = """,
mart AS (
  SELECT f.customer_token, s.propensity_score, s.score_decile, s.campaign_segment, f.feature_date
  FROM (SELECT customer_token, feature_date FROM features) f
  JOIN scores s ON f.customer_token = s.customer_token AND f.feature_date = s.feature_date)
"""
    body = "\nUNION ALL\n".join(quality_sql(m, checks, m) for m, checks in _quality_suites())
    return O.events_layers()[:-1] + _scored_snapshot_sql() + mart + body


@register("quality_report", _quality_report_sql())
def quality_report(spark, sf_dir):
    """Q1-Q7: every layer's data tests in one report (failures per check).

    Each layer is computed once, from the written copy of the one before it,
    and all its checks read that copy (as the weekly job does).
    """
    from propensia.operators.quality import quality_report as qr
    from propensia.session import materialize

    layers_ = {"bronze": materialize(events_layers(spark, sf_dir)["bronze"], "bronze")}
    layers_["silver"] = materialize(L.silver(layers_["bronze"]), "silver")
    layers_["gold"] = materialize(L.gold(L.daily_customer(layers_["silver"])), "gold")
    layers_["features"] = materialize(L.features(layers_["gold"], A.EVENTS_RUN_DATE), "features")
    layers_["mart"] = materialize(L.mart(layers_["features"], snapshot_scores(layers_["features"])[1]), "mart")
    out = None
    for model, checks in _quality_suites():
        r = qr(layers_[model], checks, model)
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------- model --
def _trained(spark, sf_dir):
    """(model, training rows, test rows) with the library's own settings."""
    from propensia.operators.training import fit_propensity_model, require_classes, temporal_split
    from propensia.session import materialize

    # both labels are looked for in the written frame: it is made once
    frame = materialize(training_inputs(spark, sf_dir, check_classes=False), "training-frame")
    require_classes(frame)
    train, test = temporal_split(frame, HOLDOUT_DAYS_EVENTS)
    return fit_propensity_model(train), train, test


@register("model_scores")
def model_scores(spark, sf_dir):
    """ML2-ML4: boosted trees (200 rounds) + 3-fold isotonic, trained on the
    train split, scoring the snapshot into the 5-column contract (rows-only check)."""
    from propensia.operators.scoring import score_features

    model, _, _ = _trained(spark, sf_dir)
    return score_features(events_layers(spark, sf_dir)["features"], model)


@register(
    "model_calibration",
    O.events_layers()[:-1] + O.labels_cte() + O.history_cte() + O.split_cte(HOLDOUT_DAYS_EVENTS)
    + f""",
dealt AS (SELECT ('0x' || substr(md5(customer_token || '|' || strftime(feature_date, '%Y-%m-%d')), 1, 8))::BIGINT % 3 AS fold, adopted_card
          FROM split WHERE split = 'train'),
ranked AS (SELECT row_number() OVER () AS r, count(*) OVER () AS n FROM features)
SELECT 'fold ' || fold AS part, count(*) AS rows, sum(adopted_card)::BIGINT AS positives, {O.r6('avg(adopted_card)')} AS mean_score
FROM dealt GROUP BY fold
UNION ALL
SELECT 'decile ' || {O.decile_sql('r', 'n')}, count(*), NULL, NULL FROM ranked GROUP BY 1""",
)
def model_calibration(spark, sf_dir):
    """ML2 + ML3 + S10 + W7: the trained model, saved and loaded: rows,
    positives and mean calibrated score of each fold, rows of each decile."""
    import uuid

    from propensia.operators.scoring import score_features
    from propensia.operators.training import calibration_report
    from propensia.session import checkpoint_dir
    from propensia.sources import lake as IO

    model, train, _ = _trained(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/propensia-model-{uuid.uuid4().hex}"
    IO.save_model(model, path)
    model = IO.load_model(path)
    folds = calibration_report(model, train).select(
        F.concat(F.lit("fold "), F.col("fold").cast("string")).alias("part"), "rows", "positives", round_half_away("mean_score", 6).alias("mean_score")
    )
    scores = score_features(events_layers(spark, sf_dir)["features"], model)
    deciles = scores.groupBy("score_decile").agg(F.count(F.lit(1)).alias("rows"))
    return folds.unionByName(
        deciles.select(
            F.concat(F.lit("decile "), F.col("score_decile").cast("string")).alias("part"), "rows",
            F.lit(None).cast("long").alias("positives"), F.lit(None).cast("double").alias("mean_score"),
        )
    )


import propensia.plans.lake_queries  # noqa: E402,F401 - registers its queries
