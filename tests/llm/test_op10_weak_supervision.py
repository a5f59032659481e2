import math
import random
import re
from collections import Counter

import duckdb
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF0001, SF001
from oracle_check import rows_of

from propensia.llm import weak_supervision as ws

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeat_words(words, run=5):
    windows = [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]
    times = Counter(windows)
    return len({p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + run)})


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat_words(words))


def test_measures_equal_brute_force(spark, awkward, nothing):  # noqa: F811
    rng = random.Random(2)
    texts = [t for _, t in AWKWARD] + [" ".join(rng.choices("ab", k=rng.randint(0, 40))) for _ in range(150)]
    texts += ["\n".join(rng.choices(["x y", "", " ", "# z | q"], k=6)) for _ in range(60)] + ["a b c d e a b c d e", "a a a a a a", "a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in ws.measures(docs).collect():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert ws.judge(awkward).count() == len(AWKWARD)
    assert ws.judge(nothing).count() == 0


@pytest.mark.parametrize("folder", [SF0001, SF001])
def test_query_equals_its_sql(spark, folder):
    df = ws.query(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    res = con.execute(ws.ORACLE_SQL)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())


def test_clean_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = ws.query(spark, SF001).join(labels, "doc_id").filter("not base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert counts[1, True] >= 0.99 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] >= 0.9 * (counts[0, False] + counts.get((0, True), 0))


def test_em_recovers_rates(spark):
    """Votes drawn from known rates: the estimates come near them."""
    rng = random.Random(4)
    rows = []
    for _ in range(6000):
        kind = rng.choices([None, *ws.CLASSES[1:]], [0.8, 0.05, 0.05, 0.05, 0.05])[0]
        votes = []
        for of, *_ in ws.RULES.values():
            junk = 0.9 if of == kind else 0.003
            votes.append(0 if rng.random() < 0.1 else -1 if rng.random() < junk else 1)
        rows.append(tuple(votes))
    model = ws.fit(spark.createDataFrame(rows, ", ".join(f"vote_{r} int" for r in ws.RULES)))
    assert math.exp(model[0][0]) == pytest.approx(0.8, abs=0.04)
    for i, (rule, (kind, *_)) in enumerate(ws.RULES.items()):
        assert math.exp(model[0][2 + 2 * i]) < 0.02, rule
        assert math.exp(model[ws.CLASSES.index(kind)][2 + 2 * i]) == pytest.approx(0.9, abs=0.12), rule


def test_filter_keeps_columns(spark, awkward):  # noqa: F811
    assert ws.keep_clean(awkward).columns == awkward.columns
