import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from propensia.operators.quality import QualityGateError
from propensia.plans import jobs as J
from propensia.sources import adapters as A
from propensia.sources import lake as IO

from conftest import SF0001


def pan_inputs(spark):
    tx = A.events_as_transactions(spark, SF0001).withColumnRenamed("customer_token", "pan")
    labels = A.customer_as_labels(spark, SF0001).filter(F.col("day") == "31").select(
        F.col("customer_token").alias("pan"), "adopted_card", "age", "tenure_months")
    return tx, labels


def test_weekly_run_and_rerun(spark, scratch):
    lake = J.Lake(scratch)
    tx, labels = pan_inputs(spark)
    out = J.run_weekly(spark, lake, "2024-01-31", tx, labels, token_key="test-key", salt="salt", holdout_days=10, max_iter=3, gate=False)
    raw = spark.read.parquet(lake.raw_transactions)
    assert "pan" not in raw.columns and raw.count() == 1000
    assert os.path.isdir(os.path.join(lake.raw_transactions, "year=2024", "month=01", "day=05"))
    feats = spark.read.parquet(lake.layer("features", "features_transactional"))
    assert feats.count() == 14
    mart = spark.read.parquet(lake.mart)
    assert mart.count() == 14 and mart.select("customer_token").distinct().count() == 14
    assert out["model_card"]["test_rows"] > 0
    failures = {(r.model, r.check, r.column): r.failures for m in out["reports"].values() for r in m}
    assert failures[("bronze", "positive", "amount")] > 0  # binding has non-positive amounts
    # rerun: same partitions replaced, identical content
    def snapshot(layer, model):
        return sorted(tuple(r) for r in spark.read.parquet(lake.layer(layer, model)).collect())

    before = {m: snapshot(l, m) for l, m in [("gold", "gold_customer_features"), ("features", "features_transactional")]}
    J.build_features(spark, lake, "2024-01-31", gate=False)
    after = {m: snapshot(l, m) for l, m in [("gold", "gold_customer_features"), ("features", "features_transactional")]}
    assert before == after
    assert len(after["features_transactional"]) == 14 and len(after["gold_customer_features"]) == 396


def test_gate_stops_on_failures(spark, scratch):
    lake = J.Lake(scratch)
    tx, labels = pan_inputs(spark)
    J.ingest(spark, lake, tx, labels, dt.date(2024, 1, 31), token_key="k", salt="salt")
    with pytest.raises(QualityGateError, match="positive"):
        J.build_features(spark, lake, "2024-01-31", gate=True)


def test_batches_share_dates_and_prune_folders(spark, scratch):
    """Late events join the rows of their date; a batch's scan opens its own folders only."""
    from propensia.operators import layers as L

    lake = J.Lake(scratch)
    tx, labels = pan_inputs(spark)
    late = F.substring("transaction_id", 5, 20).cast("long") % 4 == 0
    J.ingest(spark, lake, tx.filter(~late), None, dt.date(2024, 1, 24), token_key="k", salt="salt")
    J.ingest(spark, lake, tx.filter(late), labels, dt.date(2024, 1, 31), token_key="k", salt="salt")
    assert J.raw_transactions(spark, lake).count() == tx.count()
    for day, rows in (("2024-01-24", tx.filter(~late)), ("2024-01-31", tx.filter(late))):
        batch = J.raw_batch(spark, lake, day)
        assert L.bronze(batch, day).count() == rows.count()
    plan = J.raw_batch(spark, lake, "2024-01-24")._jdf.queryExecution().executedPlan().toString()
    assert "write" in (pruned := plan.split("PartitionFilters: [")[1].split("]")[0])
    assert "batch-2024-01-24-" in pruned and "batch-2024-01-31-" not in pruned


def test_a_rerun_replaces_its_own_batch_only(spark, scratch):
    lake = J.Lake(scratch)
    tx, _ = pan_inputs(spark)
    first, second = tx.filter("transaction_timestamp < '2024-01-20'"), tx.filter("transaction_timestamp >= '2024-01-10'")
    J.ingest(spark, lake, first, None, "2024-01-24", token_key="k", salt="salt")
    J.ingest(spark, lake, tx, None, "2024-01-31", token_key="k", salt="salt")  # too much
    J.ingest(spark, lake, second, None, "2024-01-31", token_key="k", salt="salt")  # without the days before the 10th
    raw = J.raw_transactions(spark, lake)
    by_batch = {r["_batch_id"]: r["n"] for r in raw.groupBy("_batch_id").agg(F.count("*").alias("n")).collect()}
    assert by_batch == {"batch-2024-01-24": first.count(), "batch-2024-01-31": second.count()}
    # a write that was never committed is not seen
    IO.with_hive_parts(J.raw_batch(spark, lake, "2024-01-24").drop(*IO.PARTITION_COLUMNS, "write"), F.to_date("transaction_timestamp")).withColumn(
        "write", F.lit("torn")
    ).write.mode("append").partitionBy(*IO.PARTITION_COLUMNS, "write").parquet(lake.raw_transactions)
    assert J.raw_transactions(spark, lake).count() == first.count() + second.count()


def test_compaction_keeps_the_last_of_each_transaction(spark, scratch):
    lake = J.Lake(scratch)
    tx, _ = pan_inputs(spark)
    n = F.substring("transaction_id", 5, 20).cast("long")
    nameless = tx.filter(n < 3).withColumn("transaction_id", F.lit(None).cast("string"))
    undated = tx.filter(n == 5).withColumn("transaction_timestamp", F.lit(None).cast("timestamp_ntz"))
    J.ingest(spark, lake, tx.unionByName(nameless).unionByName(undated), None, "2024-01-24", token_key="k", salt="salt")
    J.ingest(spark, lake, tx.filter(n % 3 == 0).withColumn("amount", F.lit(7.0)).unionByName(undated), None, "2024-01-31", token_key="k", salt="salt")
    before = len(IO.live_writes(spark, lake.raw_commits).collect())
    assert J.compact_raw(spark, lake) is not None
    live = IO.live_writes(spark, lake.raw_commits).collect()
    assert len({r["event_date"] for r in live}) == len(live) < before
    raw = J.raw_transactions(spark, lake)
    assert raw.count() == tx.count() + nameless.count() + 1
    assert raw.filter("amount = 7.0").count() == tx.filter(n % 3 == 0).count()
    rows = sorted(tuple(r) for r in raw.select("transaction_id", "amount", "_batch_id").filter("transaction_id is not null").collect())
    assert IO.sweep(spark, lake.raw_transactions, lake.raw_commits) > 0
    assert sorted(tuple(r) for r in J.raw_transactions(spark, lake).select("transaction_id", "amount", "_batch_id").filter("transaction_id is not null").collect()) == rows
    assert J.compact_raw(spark, lake) is None


def test_score_as_of_and_model_lookup(spark, scratch):
    lake = J.Lake(scratch)
    tx, labels = pan_inputs(spark)
    J.run_weekly(spark, lake, "2024-01-31", tx, labels, token_key="k", salt="salt", holdout_days=10, max_iter=2, gate=False)
    assert J.current_model_path(spark, lake).endswith("run_date=2024-01-31")
    J.train(spark, lake, "2024-01-31", holdout_days=10, max_iter=2)  # a rerun's card is the run's next version
    assert [r["version"] for r in IO.read_metrics(spark, lake.metrics, latest=True).collect()] == [2]
    assert IO.read_metrics(spark, lake.metrics).count() == 2
    with pytest.raises(FileNotFoundError):
        J.current_model_path(spark, lake, as_of="2024-01-01")
    # an as_of before every snapshot has nothing to score
    with pytest.raises(ValueError, match="feature_date"):
        J.score(spark, lake, "2024-02-07", as_of="2024-01-01")
    dist = {r.campaign_segment: r.customers for r in J.score(spark, lake, "2024-02-07").collect()}
    assert sum(dist.values()) == 14
    assert spark.read.parquet(lake.scores).count() == 28  # two weekly partitions
    report = {r.check: r.failures for r in J.build_mart(spark, lake, "2024-01-31", gate=False)}
    assert report["unique"] == 14  # both score runs joined, as in the original
    report = {r.check: r.failures for r in J.build_mart(spark, lake, "2024-01-31", gate=True, latest_scores_only=True)}
    assert report["unique"] == 0 and spark.read.parquet(lake.mart).count() == 14


def test_ingest_tokens_match_hmac_and_drop_pan(spark, scratch):
    import hashlib
    import hmac

    lake = J.Lake(scratch)
    tx, labels = pan_inputs(spark)
    J.ingest(spark, lake, tx, labels, dt.date(2024, 1, 31), token_key="secret-k", salt="pepper")
    raw = spark.read.parquet(lake.raw_transactions)
    assert "pan" not in raw.columns
    pans = {r.transaction_id: r.pan for r in tx.select("transaction_id", "pan").collect()}
    for r in raw.select("transaction_id", "customer_token").limit(20).collect():
        want = hmac.new(b"secret-k", f"pepper:{pans[r.transaction_id]}".encode(), hashlib.sha256).hexdigest()[:32]
        assert r.customer_token == want
    lab = spark.read.parquet(lake.raw_labels)
    assert "pan" not in lab.columns and lab.count() == 150


def test_a_failed_run_goes_on_where_it_stopped(spark, scratch):
    from propensia.operators.scoring import LinearScorer
    from propensia.plans import ledger

    lake = J.Lake(scratch)
    tx, _ = pan_inputs(spark)

    def fail(stage):
        if stage == "features":
            raise RuntimeError("executor storm")

    def run(**kw):
        return J.run_weekly(spark, lake, "2024-01-31", tx, None, "k", "salt", gate=False, model=LinearScorer(), **kw)

    with pytest.raises(RuntimeError, match="storm"):
        run(watch=fail)
    states = {r.stage: (r.state, r.error) for r in ledger.latest(spark, lake.ledger).collect()}
    assert [s for s, (state, _) in states.items() if state == "failed"] == ["features"] and "storm" in states["features"][1]
    assert run()["stages"] == ["features", "score", "mart"]
    assert run()["stages"] == []  # nothing is due
    rows = {r.stage: r.rows for r in ledger.latest(spark, lake.ledger).collect()}
    assert (rows["ingest"], rows["features"], rows["mart"]) == (1000, 14, 14)
    again = run(resume=False)
    assert again["stages"] == ["ingest", "bronze", "silver", "gold", "features", "score", "mart"]
    assert J.raw_transactions(spark, lake).count() == 1000
    # a stage done anew makes those that read it due
    stage = ledger.Stage("gold", ("silver",), lake.layer(*J.LAYERS["gold"]), lambda: 0)
    silver = next(r.entry for r in ledger.latest(spark, lake.ledger).collect() if r.stage == "silver")
    ledger.record(spark, lake.ledger, dt.date(2024, 1, 31), stage, ledger.DONE, [silver], 396)
    assert run()["stages"] == ["features", "score", "mart"]


def test_metrics_history_of_runs_that_record_at_once(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    root = f"{scratch}/metrics"
    with pytest.raises(FileNotFoundError):
        IO.read_metrics(spark, root)

    def record(n):
        row = spark.createDataFrame([(n,)], "n int")
        return IO.write_metrics(row if n % 2 else row.withColumn("more", F.lit("x")), root, f"2024-01-{10 + n % 3}")

    with ThreadPoolExecutor(9) as pool:
        assert len(set(pool.map(record, range(9)))) == 9
    record(100)
    history = IO.read_metrics(spark, root)
    versions = {}
    for r in sorted(history.collect(), key=lambda r: r["recorded_at"]):
        versions.setdefault(str(r["run_date"]), []).append((r["version"], r["n"], r["more"]))
    assert {d: sorted(v for v, _, _ in found) for d, found in versions.items()} == {
        "2024-01-10": [1, 2, 3], "2024-01-11": [1, 2, 3, 4], "2024-01-12": [1, 2, 3]
    }
    assert sorted(n for found in versions.values() for _, n, _ in found) == [*range(9), 100]
    assert versions["2024-01-11"][-1] == (4, 100, "x")
    last = IO.read_metrics(spark, root, latest=True).collect()
    assert sorted((str(r["run_date"]), r["version"]) for r in last) == [("2024-01-10", 3), ("2024-01-11", 4), ("2024-01-12", 3)]
