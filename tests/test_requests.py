import datetime as dt
import json
import os

from pyspark.sql import functions as F

from propensia.operators.scoring import LinearScorer
from propensia.streaming.requests import ARRIVALS, read_responses, score_requests, serve_requests, stream_requests


class Constant:
    def __init__(self, p):
        self.p = p

    def transform(self, df):
        return df.withColumn("propensity_score", F.lit(self.p))


GOOD = {"recency_days": 5, "frequency_30d": 12, "monetary_30d": 1500.0, "digital_ratio_30d": 0.75,
        "cross_border_count_90d": 2, "age": 32, "tenure_months": 24}


def score(spark, bodies, model=None):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    return {r.id: r for r in score_requests(df, model or Constant(0.8234)).collect()}


def test_documented_example(spark):
    r = score(spark, [json.dumps(GOOD)])[0]
    assert (r.status, r.propensity_score, r.score_decile, r.recommendation, r.expected_lift) == (
        200, 0.8234, 9, "TARGET_PREMIUM", "27.4x")


def test_errors(spark):
    no_age = {k: v for k, v in GOOD.items() if k != "age"}
    bodies = [
        "{bad", "[1, 2]", "42", json.dumps(no_age), json.dumps({**GOOD, "age": True}),
        json.dumps({**GOOD, "age": "x", "tenure_months": None}), json.dumps({**GOOD, "digital_ratio_30d": 1.5}),
        json.dumps({**GOOD, "extra": "ignored"}), "{}", None,
    ]
    r = score(spark, bodies)
    assert r[0].error == "Request body must be valid JSON."
    assert r[1].error.startswith("Missing required fields: age, cross_border_count_90d")
    assert r[2].error == "Request body must be a JSON object."
    assert r[3].error == "Missing required fields: age"
    assert r[4].error == "Fields must be numeric: age"
    assert r[5].error == "Fields must be numeric: age, tenure_months"
    assert r[6].error == "digital_ratio_30d must be between 0 and 1."
    assert r[7].status == 200
    assert r[8].error.count(",") == 6
    assert r[9].error == "Request body must be a JSON object."
    assert all(r[i].status == 400 and r[i].propensity_score is None for i in [0, 1, 2, 3, 4, 5, 6, 8])


def test_arrays_strings_and_repeated_keys(spark):
    names = sorted(GOOD)
    twice = json.dumps(GOOD)[:-1] + ', "age": 33}'
    bodies = ['["age", 1]', '"age"', json.dumps(names), twice, twice.replace('"age": 32', '"age": "x"'), twice.replace('"age": 33', '"age": "x"'), "true", "null"]
    r = score(spark, bodies)
    assert r[0].error == "Missing required fields: " + ", ".join(n for n in names if n != "age")
    assert r[1].error == "Missing required fields: " + ", ".join(names)
    assert r[2].error == r[6].error == r[7].error == "Request body must be a JSON object."
    assert r[3].status == r[4].status == 200
    assert r[5].error == "Fields must be numeric: age"


def test_scores_are_rounded_like_the_binary_value(spark):
    for p in (0.00035, 0.00045, 0.12345, 0.5, 0.99995, 2.5e-05, 0.00015):
        assert score(spark, [json.dumps(GOOD)], Constant(p))[0].propensity_score == round(p, 4), p


def test_model_that_requests_cannot_feed(spark):
    r = score(spark, [json.dumps(GOOD), "{bad"], LinearScorer({"age": 0.1, "merchant_diversity_30d": 1.0}))
    assert (r[0].status, r[0].error, r[0].propensity_score) == (500, "Model load or scoring failed.", None)
    assert r[1].status == 400


def test_linear_scorer_in_requests(spark):
    r = score(spark, [json.dumps(GOOD)], LinearScorer())[0]
    assert r.status == 200 and 0 < r.propensity_score < 1


def test_streaming_available_now(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.jsonl"), "w") as fh:
        fh.write(json.dumps(GOOD) + "\n" + "{bad\n")
    seen = []
    stream_requests(spark, src, Constant(0.5), lambda df, epoch: seen.extend(df.collect()), os.path.join(scratch, "ckpt"))
    assert sorted(r.status for r in seen) == [200, 400]


def arrivals(spark, rows, source):
    stamped = [(i, dt.datetime(2024, 1, 31, 12, minute), body) for i, minute, body in rows]
    spark.createDataFrame(stamped, ARRIVALS).coalesce(1).write.mode("append").json(source)


def test_replayed_epoch_and_repeated_requests_are_answered_once(spark, scratch):
    source, out, checkpoint = (os.path.join(scratch, p) for p in ("in", "out", "ckpt"))
    serve = lambda: serve_requests(spark, source, Constant(0.5), out, checkpoint)
    good = json.dumps(GOOD)
    arrivals(spark, [("a", 0, good), ("b", 1, "{bad"), ("a", 2, good), (None, 3, good), (None, 3, good), (None, 4, good), (None, 4, None)], source)
    serve()
    answered = lambda: sorted((r.request_id or "", r.status) for r in read_responses(spark, out).collect())
    first = [("", 200), ("", 200), ("", 400), ("a", 200), ("b", 400)]
    assert answered() == first
    arrivals(spark, [("a", 10, good), ("c", 11, good)], source)
    serve()
    both = sorted([*first, ("c", 200)])
    assert answered() == both
    # killed after the sink has written, before the epoch was committed
    commits = os.path.join(checkpoint, "commits")
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.replace(os.path.join(commits, name), os.path.join(scratch, name))
    serve()
    assert answered() == both
    serve()  # nothing new
    assert answered() == both
