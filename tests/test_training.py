import datetime as dt

import pytest
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.operators import training as T
from propensia.operators.dedup import keep_last, latest_labels
from propensia.operators.scoring import score_features
from propensia.sources import lake as IO


def feature_rows(spark, n_customers=40, days=40):
    rows = []
    base = dt.date(2024, 1, 1)
    for c in range(n_customers):
        for d in range(0, days, 2):
            rows.append((f"c{c:03d}", base + dt.timedelta(days=d), 0, 5 + c % 7 + d % 3, 100.0 * (c % 5) + d,
                         (c % 10) / 10, c % 3, 25 + c % 30, 1 + c % 100))
    return spark.createDataFrame(rows, "customer_token string, feature_date date, recency_days long, txn_count_30d long, "
                                 "volume_30d double, digital_ratio_30d double, cross_border_count_90d long, age int, tenure_months int")


def label_rows(spark, n_customers=40):
    rows = [(f"c{c:03d}", 1 if c % 4 == 0 else 0, dt.date(2024, 2, 10)) for c in range(n_customers)]
    rows += [(f"c{c:03d}", 1 - (1 if c % 4 == 0 else 0), dt.date(2024, 2, 3)) for c in range(n_customers)]
    return spark.createDataFrame(rows, "customer_token string, adopted_card int, _ingestion_date date")


def test_keep_last_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "q")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in keep_last(df, ["k"], ["o"]).collect()}
    assert got == {"a": (2, "z"), "b": (1, "q")}


def test_labels_keep_latest_ingestion(spark):
    got = {r.customer_token: r.adopted_card for r in latest_labels(label_rows(spark)).collect()}
    assert got["c000"] == 1 and got["c001"] == 0


def test_prepare_and_split(spark):
    frame = T.prepare_training_frame(feature_rows(spark), label_rows(spark))
    assert frame.count() == 40 * 20
    train, test = T.temporal_split(frame, holdout_days=10)
    assert train.agg(F.max("feature_date")).first()[0] <= dt.date(2024, 1, 29)
    assert test.agg(F.min("feature_date")).first()[0] > dt.date(2024, 1, 29)
    w = T.class_weight(train).first()
    assert w.positives > 0 and w.scale_pos_weight == pytest.approx(w.negatives / w.positives)
    with pytest.raises(ValueError):
        T.temporal_split(frame, holdout_days=400)


def test_contract_errors(spark):
    with pytest.raises(ValueError, match="columns not found"):
        T.prepare_training_frame(feature_rows(spark).drop("age"), label_rows(spark))
    one_class = label_rows(spark).withColumn("adopted_card", F.lit(0))
    with pytest.raises(ValueError, match="one class only"):
        T.prepare_training_frame(feature_rows(spark), one_class)


def test_stratified_folds_balanced(spark):
    frame = T.prepare_training_frame(feature_rows(spark), label_rows(spark))
    folds = T.stratified_folds(frame).groupBy("adopted_card", "fold").count().collect()
    by_class = {}
    for r in folds:
        by_class.setdefault(r.adopted_card, []).append(r["count"])
    assert all(len(v) == 3 and min(v) >= 0.5 * max(v) for v in by_class.values())


def test_fit_save_load_score(spark, scratch):
    frame = T.prepare_training_frame(feature_rows(spark), label_rows(spark))
    train, test = T.temporal_split(frame, holdout_days=10)
    model = T.fit_propensity_model(train, max_iter=3)
    IO.save_model(model, f"{scratch}/model")
    loaded = IO.load_model(f"{scratch}/model")
    assert IO.model_features(loaded) == S.FEATURE_COLUMNS
    snap = test.filter(F.col("feature_date") == test.agg(F.max("feature_date")).first()[0])
    scores = score_features(snap, loaded).collect()
    assert len(scores) == snap.count()
    assert all(0.0 <= r.propensity_score <= 1.0 and 1 <= r.score_decile <= 10 for r in scores)
    assert [c for c in scores[0].asDict()] == S.SCORE_COLUMNS


def test_requests_with_fitted_model_batch_and_stream(spark, scratch):
    import json
    import os

    from propensia.streaming.requests import score_requests, stream_requests

    frame = T.prepare_training_frame(feature_rows(spark), label_rows(spark))
    train, _ = T.temporal_split(frame, holdout_days=10)
    model = T.fit_propensity_model(train, max_iter=3)
    good = {"recency_days": 0, "frequency_30d": 9, "monetary_30d": 210.0, "digital_ratio_30d": 0.3,
            "cross_border_count_90d": 1, "age": 40, "tenure_months": 12}
    bodies = [json.dumps(good), "{bad", json.dumps({**good, "age": None})]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    out = {r.id: r for r in score_requests(df, model).collect()}
    assert out[0].status == 200 and 0.0 <= out[0].propensity_score <= 1.0 and out[0].expected_lift.endswith("x")
    assert out[1].status == 400 and out[2].status == 400 and out[2].propensity_score is None
    src = os.path.join(scratch, "req")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as fh:
        fh.write("\n".join(bodies) + "\n")
    seen = []
    stream_requests(spark, src, model, lambda b, e: seen.extend(b.collect()), os.path.join(scratch, "ck"))
    assert sorted(r.status for r in seen) == [200, 400, 400]
