import random

import numpy as np
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF001

from propensia.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distances():
    rng = random.Random(7)
    terms = {"".join(rng.choices("abc", k=rng.randint(3, 11))): rng.random() for _ in range(40)}
    automaton = tx.LexiconAutomaton(terms)
    for _ in range(3000):
        word = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        ends = [(distance(word, t), -w, t) for t, w in terms.items() if distance(word, t) <= tx.errors_allowed(t)]
        want = (min(ends)[2], min(ends)[0]) if ends else None
        assert automaton.find(word) == want
    assert tx.LexiconAutomaton({}).find("word") is None


def test_context_separates_quotation_from_abuse():
    model = tx.ToxicModel(words={"idiot": 5.0}, weights=[0.0, 1.0, 0, 0, 0, 0, 0, 0])
    scorer = tx.Scorer(model)
    abuse, plain, quoted = (scorer.features(t)[1] for t in ("you are an idiot", "such an idiot came by", 'he said the word "idiot" was used then'))
    assert abuse > plain > quoted
    assert scorer.features("an idot! came by")[3] > 0  # misspelled
    assert scorer.features("idiot###")[1] > 0
    assert scorer.features("")[1:] == [0.0] * (tx.N_FEATURES - 1)


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(1)
    x = np.c_[np.ones(400), rng.normal(size=(400, 3))]
    y = (rng.random(400) < 1 / (1 + np.exp(-x @ np.array([0.3, 2.0, -1.0, 0.0])))).astype(float)
    w = tx.fit_logistic(x, y)
    gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + np.array([1e-6, 1, 1, 1]) * w
    assert np.abs(gradient).max() < 1e-4


@pytest.fixture(scope="module")
def planted(spark):
    """Texts of invented words; toxic ones hold some of ten terms, a stem or a misspelling."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(3000)]
    terms = ["blorg", "frenk", "snivvel", "quaggish", "drimble"]
    rows, labels = [], []
    for k in range(1500):
        words, toxic = rng.choices(vocabulary, k=rng.randint(5, 120)), int(k % 8 == 0)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice([*terms, "zork" + "".join(rng.choices("aeiou", k=3))]))
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark, planted):
    docs, labels = planted
    model = tx.learn(docs, labels)
    assert {"blorg", "frenk", "snivvel", "quaggish", "drimble"} <= set(model.words) and "zork" in {s[:4] for s in model.stems}
    scored = tx.score_documents(docs, model).join(labels, "doc_id").withColumn("held", tx.hold_out("doc_id", 5) == 0)
    held = scored.filter("held").collect()
    assert len(held) > 200
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in held) >= 0.98 * len(held)


def test_lexicon_counts_rows_beyond_the_regressions_sample(spark, planted, monkeypatch):
    docs, labels = planted
    whole, few = tx.learn(docs, labels), tx.learn(docs, labels, sample=200)
    assert few.words == whole.words and few.stems == whole.stems and few.weights != whole.weights
    rows = tx.labelled_rows(docs, labels, key="doc_id", text="text", modulus=5)
    keys, gain = tx.regression_keys(rows, 200)
    shares = {r["toxic"]: r["count"] for r in keys.join(rows, "k").groupBy("toxic").count().collect()}
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    assert shares == {0: 100, 1: 100} and gain == pytest.approx(np.log(sizes[0] / sizes[1]))
    scored = tx.score_documents(docs, few).join(labels, "doc_id").filter(tx.hold_out("doc_id", 5) == 0).collect()
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in scored) >= 0.98 * len(scored)
    monkeypatch.setattr(tx, "SMALL_KEYS", 0)  # labels too large to be sent to all tasks
    assert tx.learn(docs, labels) == whole


def test_tied_and_repeated_rows_are_learned_from(spark, planted):
    docs, labels = planted
    assert tx.learn(docs.union(docs), labels.union(labels)).words.keys() == tx.learn(docs, labels).words.keys()


def test_held_out_rows_are_never_learned_from(spark, planted):
    docs, labels = planted
    flipped = labels.withColumn("toxic", tx.F.when(tx.hold_out("doc_id", 5) == 0, 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    assert tx.learn(docs, labels) == tx.learn(docs, flipped)


def test_awkward_rows(spark, awkward, nothing, planted):  # noqa: F811
    model = tx.learn(*planted)
    rows = tx.score_documents(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert tx.score_documents(nothing, model).count() == 0
    empty = tx.learn(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] < 0.5 for r in tx.score_documents(awkward, empty).collect())
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, toxic int")
    assert tx.learn(awkward, odd).words == {}


def test_query_on_the_given_table(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = tx.query(spark, SF001).join(labels, "doc_id").collect()
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.65 * len(toxic)
