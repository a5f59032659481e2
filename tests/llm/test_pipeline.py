import corpus_pipeline as pipeline
from awkward_rows import awkward, norm, nothing  # noqa: F401
from conftest import SF0001
from pyspark.sql import functions as F
from test_op4_chosen_path import brute

from propensia.llm import packing, toxicity, weak_supervision
from propensia.llm.common import materialize


def test_stages_take_effect_and_compose(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, last = docs.columns, docs
    for name, stage in pipeline.STAGES[:-1]:
        after = materialize(stage(spark, last, SF0001), f"test-{name}")
        assert after.columns == columns and after.exceptAll(last).isEmpty()
        if name == "toxicity":
            model = toxicity.learn(docs, spark.read.parquet(f"{SF0001}/labels.parquet"))
            scorer = toxicity.Scorer(model)
            want = {r["doc_id"] for r in last.collect() if scorer.score(r["text"] or "") < 0.5}
        elif name == "quality":
            want = {r["doc_id"] for r in weak_supervision.judge(last).filter("kept").collect()}
        else:
            rows = [(r["doc_id"], r["text"]) for r in last.collect()]
            want = {k for k, _, least in brute(rows) if k == least}
        assert {r["doc_id"] for r in after.collect()} == want, name
        last = after
    packed = pipeline.run(spark, SF0001)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in last.collect()}
    assert packed.count() == packing.pack_documents(last).count()
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]


CLASHES = ["_toxicity", "_TEXT_HASH", "_gone_key", "_gone_hash", "score", "quality", "group", "component_id"]


def test_awkward_rows_and_clashing_columns_pass_through(spark, awkward):
    marked = awkward.select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))
    marked = materialize(marked, "test-awkward")
    for name, stage in pipeline.STAGES[:-1]:
        plain = stage(spark, awkward, SF0001)
        kept = materialize(stage(spark, marked, SF0001), f"test-{name}")
        assert kept.columns == marked.columns, name
        assert norm(kept.select(awkward.columns).collect()) == norm(plain.select(awkward.columns).collect()), name
        assert kept.exceptAll(marked).isEmpty(), name
    packed = pipeline.pack(spark, marked, SF0001)
    assert packed.agg(F.sum("length")).first()[0] == packing.pack_documents(awkward).agg(F.sum("length")).first()[0]


def test_what_the_stages_do_to_awkward_rows(spark, awkward):
    rows = awkward.count()
    toxic_free = pipeline.drop_toxic(spark, awkward, SF0001)
    assert toxic_free.filter("text is null or text = ''").count() == awkward.filter("text is null or text = ''").count()
    clean = pipeline.drop_junk(spark, awkward, SF0001)
    assert clean.filter("text is null or trim(text) = ''").count() == 0
    apart = pipeline.drop_near_duplicates(spark, awkward, SF0001)
    assert apart.count() < rows
    texts = [r["text"] for r in apart.collect()]
    assert texts.count(None) == 1 and sum(t is not None and t.startswith("The quick") for t in texts) == 1
    assert sum(t is not None and t.startswith("a row without a key") for t in texts) == 1


def test_empty_table(spark, nothing):
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, nothing, SF0001)
        assert out.columns == nothing.columns and out.count() == 0
    assert pipeline.pack(spark, nothing, SF0001).count() == 0
