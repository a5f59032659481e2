import pytest
import sentencepiece
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF0001
from hypothesis import given, settings
from hypothesis import strategies as st

from propensia.llm import sentencepiece_dropout as sp


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.default_path())


def test_no_dropout_equals_the_library(spark, library):
    texts = [r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    texts += [t for _, t in AWKWARD if t and "▁" not in t]
    encoder = sp.Encoder(sp.default_path(), 0.0, 0, 8)
    for t in texts:
        assert encoder.encode(t) == library.encode(t)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab the▁ \n\t.é日🎉<s>0x41"), max_size=40), st.integers(0, 5))
def test_every_text_decodes_to_itself(text, seed):
    for rate in (0.0, 0.3, 1.0):
        encoder = sp.Encoder(sp.default_path(), rate, seed, 4)
        assert encoder.model.decode(encoder.encode(text, seed)) == text


def test_short_and_long_agenda_agree():
    ranks = sp.model(sp.default_path()).ranks
    for chunk in ("▁international", "▁▁▁▁wordword", "▁schönheiten", "a"):
        for key in range(60):
            assert sp._merge_short(chunk, ranks, 1 << 30, key * 7919) == sp._merge_long(chunk, ranks, 1 << 30, key * 7919)


def test_dropout_varies_and_repeats(library):
    text = "internationalisation of unbelievable things and other words " * 6
    a = sp.Encoder(sp.default_path(), 0.2, 1, 8)
    first = a.encode(text, 1)
    assert first == sp.Encoder(sp.default_path(), 0.2, 1, 8).encode(text, 1)
    assert first != a.encode(text, 2) and first != sp.Encoder(sp.default_path(), 0.2, 2, 8).encode(text, 1)
    assert len(first) > len(library.encode(text))
    cuts = {tuple(a.encode("internationalisation", k)) for k in range(40)}
    assert len(cuts) > 2
    assert len(sp.Encoder(sp.default_path(), 1.0, 1, 8).encode("abc de")) == 7  # every merge skipped: letters and spaces


def test_documents_round_trip(spark, awkward, nothing):  # noqa: F811
    back = sp.decode_documents(sp.encode_documents(awkward), text="text").collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=key) == sorted(AWKWARD, key=key)
    assert sp.decode_documents(sp.encode_documents(nothing)).count() == 0
    whole = sp.query(spark, SF0001)
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").selectExpr("doc_id", "crc32(cast(text as binary)) as c")
    assert whole.join(docs, "doc_id").filter("c = decoded_crc32").count() == docs.count() == whole.count()


def test_every_occurrence_draws_its_own_skips():
    """No small number of segmentations a word or a long chunk."""
    encoder = sp.Encoder(sp.default_path(), 0.1, 0)
    coded = encoder.encode_many(["internationalisation"] * 4000, list(range(4000)))
    assert len({tuple(ids) for ids in coded}) > 30
    line = "internationalisationunbelievable" * 6
    assert len({tuple(encoder.encode(line, k)) for k in range(40)}) > 30


def test_outcomes_follow_the_chance_of_their_skips():
    """Shares of the segmentations equal those of merging with one draw a candidate."""
    import random
    from collections import Counter

    n, m = 20_000, sp.model(sp.default_path())
    got = Counter(tuple(x) for x in sp.Encoder(sp.default_path(), 0.2, 3).encode_many(["unbelievable"] * n, list(range(n))))
    rng = random.Random(1)
    want = Counter(m.chunk_ids("▁unbelievable", int(0.2 * (1 << 32)), rng.getrandbits(64)) for _ in range(n))
    assert sum(abs(got[k] - want[k]) for k in got | want) < 0.1 * n


def test_remembered_outcomes_change_nothing(monkeypatch):
    texts = ["some words and other words, unbelievable words", "日本" * 40, "", "x" * 60 + " words"] * 30
    whole = sp.Encoder(sp.default_path(), 0.3, 1).encode_many(texts, list(range(120)))
    monkeypatch.setattr(sp, "REMEMBERED", 0)
    fresh = sp.Encoder(sp.default_path(), 0.3, 1)
    assert [x.tolist() for x in whole] == [fresh.encode(t, k) for k, t in enumerate(texts)]


def test_batches_are_cut_by_texts_and_characters(spark, monkeypatch):
    texts = ["a" * n for n in (3, 0, 5, 40, 1, 1, 1, 12)] + [None, "é" * 9]
    docs = spark.createDataFrame([(i, "word and other words " * n) for i, n in enumerate((1, 400, 0, 3, 900, 2, 2))], "doc_id long, text string").coalesce(1)
    whole = sorted((r["doc_id"], tuple(r["pieces"])) for r in sp.encode_documents(docs).collect())
    monkeypatch.setattr(sp, "TEXTS", 3)
    monkeypatch.setattr(sp, "CHARACTERS", 10)
    column = sp.pa.array(texts)
    cuts = list(sp.stretches(column))
    assert [i for low, high in cuts for i in range(low, high)] == list(range(len(texts)))
    for low, high in cuts:
        assert 0 < high - low <= 3 and (high - low == 1 or sum(len(t or "") for t in texts[low:high]) <= 10)
    assert list(sp.stretches(column.slice(2, 3))) == [(0, 1), (1, 2), (2, 3)] and list(sp.stretches(column.slice(0, 0))) == []
    encoder = sp.Encoder(sp.default_path(), 0.1, 0, 0)
    rows = docs.collect()
    alone = [(r["doc_id"], tuple(encoder.encode_many([r["text"]], [r["doc_id"]])[0].tolist())) for r in rows]
    assert sorted(alone) == whole
