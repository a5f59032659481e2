"""The weekly jobs over a lake root.

Layout (Hive partitions, zstd Parquet)::

    raw/transactions/year=/month=/day=/write=   event date   (B6)
    raw/commits                                 log of the writes that count
    raw/customer_labels/year=/month=/day=       run date     (B6)
    bronze|silver|gold|features/<model>/year=/month=/day=    run date (B1)
    scores/weekly/year=/month=/day=             score date   (B3)
    marts/mart_campaign_segments/year=/...      run date     (B4)
    models/propensity/run_date=YYYY-MM-DD       PipelineModel (B2)
    metrics/run_metrics/year=/month=/day=/write= history of the training runs' rows (B2)
    ledger                                      finished and failed stages of the weekly runs (B5)

Every layer is written and read back before the next one: the written
partition is the lineage cut (a lost executor recomputes from the last
written layer, not from raw), and the quality gate runs on exactly what
was published. Writes use dynamic partition overwrite, so rerunning a
stage replaces its own partitions and nothing else.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions.expr import as_date_literal
from propensia.functions.tokenize import stable_customer_token
from propensia.operators import layers as L
from propensia.operators import quality as Q
from propensia.session import ensure_conf, materialize
from propensia.sources import lake as IO

MODEL_NAME = "card_adoption_propensity"
MODEL_VERSION = "1.0.0"


def _d(d) -> _dt.date:
    """The run date; ``None`` means today in UTC (scheduled runs)."""
    if d is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_transactions(self):
        return self.path("raw", "transactions")

    @property
    def raw_commits(self):
        return self.path("raw", "commits")

    @property
    def raw_labels(self):
        return self.path("raw", "customer_labels")

    def layer(self, layer: str, model: str):
        return self.path(layer, model)

    @property
    def scores(self):
        return self.path("scores", "weekly")

    @property
    def mart(self):
        return self.path("marts", "mart_campaign_segments")

    def model(self, run_date):
        return self.path("models", "propensity", f"run_date={_d(run_date).isoformat()}")

    @property
    def ledger(self):
        return self.path("ledger")

    @property
    def metrics(self):
        return self.path("metrics", "run_metrics")


def _partition(spark: SparkSession, root: str, run_date) -> DataFrame:
    """Read back one run-date partition (pruned to that directory)."""
    d = _d(run_date)
    df = IO.read_prefix(spark, root)
    # discovery types the partition values as int; int literals also match
    # zero-padded strings when type inference is switched off
    return df.filter((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)).drop(
        *IO.PARTITION_COLUMNS
    )


def _gate(df: DataFrame, checks, model: str, gate: bool) -> list:
    """The report's rows, computed once (a row per check)."""
    report = Q.quality_report(df, checks, model).collect()
    if gate:
        Q.assert_passing(report)
    return report


# ------------------------------------------------------------------ B6 --
def ingest(
    spark: SparkSession,
    lake: Lake,
    transactions_with_pan: DataFrame,
    labels_with_pan: DataFrame | None,
    run_date,
    token_key: str,
    salt: str,
) -> None:
    """Tokenise the PAN, drop it, stamp the batch and add it to the raw table.

    Events for dates that earlier batches have join those; running a batch
    again replaces its own rows only (``lake.merge_write``)."""
    ensure_conf(spark)
    d = _d(run_date)
    stamp = [
        as_date_literal(d).alias("_ingestion_date"),
        F.to_timestamp(F.lit(f"{d.isoformat()} 00:00:00")).alias("_ingestion_timestamp"),
        F.lit(batch_id(d)).alias("_batch_id"),
    ]
    tx = transactions_with_pan.select(
        stable_customer_token("pan", token_key, salt).alias("customer_token"),
        *[c for c in transactions_with_pan.columns if c not in ("pan", "_ingestion_date", "_ingestion_timestamp", "_batch_id")],
        *stamp,
    ).select(*[f.name for f in S.RAW_TRANSACTIONS.fields])
    IO.merge_write(tx, lake.raw_transactions, lake.raw_commits, F.to_date("transaction_timestamp"), batch_id(d))
    if labels_with_pan is not None:
        lab = labels_with_pan.select(
            stable_customer_token("pan", token_key, salt).alias("customer_token"),
            "adopted_card",
            "age",
            "tenure_months",
            F.date_sub(as_date_literal(d), 1).alias("label_date"),
            *stamp,
        )
        IO.write_run_partition(lab, lake.raw_labels, d)


# ------------------------------------------------------------------ B1 --
def batch_id(run_date) -> str:
    return f"batch-{_d(run_date).isoformat()}"


def raw_batch(spark: SparkSession, lake: Lake, run_date) -> DataFrame:
    """The committed raw rows of one batch; only its own and compacted folders are scanned."""
    return IO.read_live(spark, lake.raw_transactions, lake.raw_commits, S.RAW_TRANSACTIONS, batch_id(run_date))


def raw_transactions(spark: SparkSession, lake: Lake) -> DataFrame:
    """The committed raw rows of all batches."""
    return IO.read_live(spark, lake.raw_transactions, lake.raw_commits, S.RAW_TRANSACTIONS)


def compact_raw(spark: SparkSession, lake: Lake, dates: list[_dt.date] | None = None) -> str | None:
    """Merge the batches of each event date; of a transaction sent twice for it, the later batch's row stays."""
    order = ["_ingestion_date", "_ingestion_timestamp"]
    return IO.compact(spark, lake.raw_transactions, lake.raw_commits, S.RAW_TRANSACTIONS, "transaction_id", order, dates)


#: layer: (folder of the layer, model)
LAYERS = {
    "bronze": ("bronze", "bronze_transactions"),
    "silver": ("silver", "silver_transactions"),
    "gold": ("gold", "gold_customer_features"),
    "features": ("features", "features_transactional"),
}


def build_layer(spark: SparkSession, lake: Lake, run_date, layer: str, gate: bool = True) -> list:
    """Build one layer of a run from the written one before it, and gate it. Returns its quality report."""
    ensure_conf(spark)
    d = _d(run_date)
    before = lambda name: _partition(spark, lake.layer(*LAYERS[name]), d)
    # A folder a batch: raw folders of other batches' writes are not scanned.
    make = {
        "bronze": lambda: L.bronze(raw_batch(spark, lake, d), d),
        "silver": lambda: L.silver(before("bronze")),
        "gold": lambda: L.gold(L.daily_customer(before("silver"))),
        "features": lambda: L.features(before("gold"), d),
    }[layer]
    checks = {"bronze": Q.bronze_checks, "silver": Q.silver_checks, "gold": lambda: Q.gold_checks(as_of=d), "features": Q.features_checks}[layer]
    IO.write_run_partition(make(), lake.layer(*LAYERS[layer]), d)
    return _gate(before(layer), checks(), layer, gate)


def build_features(spark: SparkSession, lake: Lake, run_date, gate: bool = True) -> dict[str, list]:
    """Bronze -> silver -> gold -> features for one run date, gated.

    Returns the rows of each layer's quality report.
    """
    return {layer: build_layer(spark, lake, run_date, layer, gate) for layer in LAYERS}


# ------------------------------------------------------------------ B2 --
def train(
    spark: SparkSession,
    lake: Lake,
    run_date,
    holdout_days: int = S.HOLDOUT_DAYS,
    max_iter: int = S.GBT_MAX_ITER,
    limitations: list[str] | None = None,
) -> dict:
    """Training frame -> split -> GBT + isotonic -> metrics -> model card.

    ``limitations`` goes onto the card as the caller states it.
    """
    from propensia.operators.metrics import evaluation_metrics
    from propensia.operators.scoring import predict
    from propensia.operators.training import fit_propensity_model, prepare_training_frame, temporal_split

    ensure_conf(spark)
    d = _d(run_date)
    features = IO.read_prefix(spark, lake.layer("gold", "gold_customer_features"), positions=True)
    labels = IO.read_raw_labels(spark, lake.raw_labels, positions=True)
    frame = prepare_training_frame(features, labels).drop(*IO.PARTITION_COLUMNS)
    frame = materialize(frame, "training-frame")  # split guards, weights and folds reuse it
    train_df, test_df = temporal_split(frame, holdout_days)
    model = fit_propensity_model(train_df, max_iter=max_iter)
    IO.save_model(model, lake.model(d))
    scored = predict(test_df, model)
    metrics = evaluation_metrics(scored, "adopted_card", "propensity_score", ["customer_token", "feature_date"]).first().asDict()
    card = {
        "model_name": MODEL_NAME,
        "version": MODEL_VERSION,
        "training_date": d.isoformat(),
        "model_path": lake.model(d),
        "train_rows": train_df.count(),
        "test_rows": metrics["n"],
        "performance": {k: metrics[k] for k in ("pr_auc", "precision_at_10", "lift_at_10", "brier_score")},
        "metrics": {k: metrics[k] for k in ("pr_auc", "roc_auc", "precision_at_10", "lift_at_10", "brier_score")},
        "features_used": list(S.FEATURE_COLUMNS),
        "limitations": list(limitations or []),
        "refresh_cycle": "weekly",
    }
    row = spark.createDataFrame(
        [(card["model_name"], card["version"], d, card["model_path"], json.dumps(card, sort_keys=True))],
        "model_name string, version string, training_date date, model_path string, model_card string",
    )
    IO.write_metrics(row, lake.metrics, d)
    return card


def model_card(spark: SparkSession, lake: Lake, run_date) -> dict:
    """The card of the last training of a run date."""
    row = IO.read_metrics(spark, lake.metrics, latest=True).filter(F.col("run_date") == as_date_literal(_d(run_date))).first()
    if row is None:
        raise FileNotFoundError(f"No model was trained for {run_date}.")
    return json.loads(row["model_card"])


def current_model_path(spark: SparkSession, lake: Lake, as_of=None) -> str:
    """Newest trained model (optionally trained on/before ``as_of``)."""
    m = IO.read_metrics(spark, lake.metrics, latest=True)
    if as_of is not None:
        m = m.filter(F.col("training_date") <= as_date_literal(as_of))
    row = m.orderBy(F.col("training_date").desc()).select("model_path").first()
    if row is None:
        raise FileNotFoundError("No trained propensity model is registered.")
    return row[0]


# ------------------------------------------------------------------ B3 --
def score(spark: SparkSession, lake: Lake, score_date, model=None, as_of=None) -> DataFrame:
    """Newest snapshot -> model -> deciles/segments -> weekly score partition.

    Returns the segment distribution (A9) of what was written.
    """
    from propensia.operators.metrics import segment_distribution
    from propensia.operators.scoring import latest_snapshot, predict, require_rows, to_score_contract

    ensure_conf(spark)
    d = _d(score_date)
    features = IO.read_prefix(spark, lake.layer("features", "features_transactional"), positions=True)
    snap = require_rows(latest_snapshot(features, as_of).drop(*IO.PARTITION_COLUMNS, *IO.POSITION_COLUMNS))
    if model is None:
        model = IO.load_model(current_model_path(spark, lake, as_of or d))
    scored = predict(snap, model)  # ranking writes it once before its passes
    IO.write_run_partition(to_score_contract(scored), lake.scores, d)
    written = _partition(spark, lake.scores, d)
    return segment_distribution(written)


# ------------------------------------------------------------------ B4 --
def build_mart(spark: SparkSession, lake: Lake, run_date, gate: bool = True, latest_scores_only: bool = False) -> list:
    """Snapshot of the run joined to every published score, gated.

    Like the original, every weekly score partition is joined, so two score
    runs for the same feature date duplicate customers (the uniqueness test
    catches it). ``latest_scores_only`` keeps the newest score partition's
    row per (customer, feature date) instead.
    """
    from propensia.operators.dedup import keep_last

    ensure_conf(spark)
    d = _d(run_date)
    feats = _partition(spark, lake.layer("features", "features_transactional"), d)
    # The snapshot holds feature_date = run_date - 1 only, so this filter is
    # implied by the equi-join; stating it lets every weekly score file skip
    # row groups by Parquet statistics instead of joining all history.
    scores = IO.read_scores(spark, lake.scores)
    scores = scores.filter(F.col("feature_date").cast("date") == F.date_sub(as_date_literal(d), 1))
    if latest_scores_only:
        scores = keep_last(scores, ["customer_token", "feature_date"], IO.PARTITION_COLUMNS)
    scores = scores.drop(*IO.PARTITION_COLUMNS)
    IO.write_run_partition(L.mart(feats, scores), lake.mart, d)
    mart = _partition(spark, lake.mart, d)
    return _gate(mart, Q.mart_checks(), "mart", gate)


# ------------------------------------------------------------------ B5 --
def run_weekly(
    spark: SparkSession,
    lake: Lake,
    run_date,
    transactions_with_pan: DataFrame,
    labels_with_pan: DataFrame | None,
    token_key: str,
    salt: str,
    holdout_days: int = S.HOLDOUT_DAYS,
    max_iter: int = S.GBT_MAX_ITER,
    gate: bool = True,
    limitations: list[str] | None = None,
    model=None,
    resume: bool = True,
    watch=None,
) -> dict:
    """Ingest -> features -> train -> score -> mart, in order, kept in the ledger.

    A run that failed is called again and goes on at the stage that failed;
    finished stages are skipped while what they read is unchanged. To take in
    other input for the same date, pass ``resume=False``. With a ``model`` no
    training takes place. ``stages`` of the result names what ran.
    """
    from propensia.operators.metrics import segment_distribution
    from propensia.plans.ledger import Stage, run_stages

    ensure_conf(spark)
    d = _d(run_date)
    out: dict = {"reports": {}, "model_card": None, "mart_report": None}

    def rows(path: str) -> int:
        return _partition(spark, path, d).count()

    def ingest_stage() -> int:
        ingest(spark, lake, transactions_with_pan, labels_with_pan, d, token_key, salt)
        return raw_batch(spark, lake, d).count()

    def layer_stage(layer: str):
        def run() -> int:
            out["reports"][layer] = build_layer(spark, lake, d, layer, gate)
            return rows(lake.layer(*LAYERS[layer]))

        return run

    def train_stage() -> int:
        out["model_card"] = train(spark, lake, d, holdout_days=holdout_days, max_iter=max_iter, limitations=limitations)
        return out["model_card"]["train_rows"]

    def score_stage() -> int:
        score(spark, lake, d, model=model)
        return rows(lake.scores)

    def mart_stage() -> int:
        out["mart_report"] = build_mart(spark, lake, d, gate=gate)
        return rows(lake.mart)

    stages = [Stage("ingest", (), lake.raw_transactions, ingest_stage)]
    for layer, before in zip(LAYERS, ["ingest", *LAYERS]):
        stages.append(Stage(layer, (before,), lake.layer(*LAYERS[layer]), layer_stage(layer)))
    if model is None:
        stages.append(Stage("train", ("ingest", "gold"), lake.model(d), train_stage))
    stages.append(Stage("score", ("features",) if model is not None else ("features", "train"), lake.scores, score_stage))
    stages.append(Stage("mart", ("features", "score"), lake.mart, mart_stage))
    out["stages"] = run_stages(spark, lake.ledger, d, stages, resume=resume, watch=watch)
    if model is None and out["model_card"] is None:  # trained by an earlier call
        out["model_card"] = model_card(spark, lake, d)
    out["distribution"] = segment_distribution(_partition(spark, lake.scores, d))
    return out
