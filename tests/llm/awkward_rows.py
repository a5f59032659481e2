"""Fixtures of the corpus operators' tests."""

import pytest

SF0001 = "/root/testdata/sf0.001"

#: Nulls in any column, empty and blank texts, ties, repeated rows, a very
#: long text, odd characters; columns whose names clash with the operators' own.
LONG = " ".join(f"word{i % 977} and{i % 13}." for i in range(12_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog. It was quick!\nA second line here.\n\nA new section starts."),
    (2, "The quick brown fox jumps over the lazy dog. It was quick!\nA second line here.\n\nA new section starts."),
    (2, "another text with the same key, of some words more than ten in all"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b\x0c\r "),
    (6, "one"),
    (7, "ümlaut çedilla 日本語 テスト 🎉 ▁ x y\x1fz"),
    (7, "ümlaut çedilla 日本語 テスト 🎉 ▁ x y\x1fz"),
    (None, "a row without a key but with words enough to be a document of its own"),
    (None, "a row without a key but with words enough to be a document of its own"),
    (8, "x" * 30_000),
    (9, LONG),
    (10, "<|endoftext|> is plain text here\n\n\n\nend"),
]
CLASHING = "node long, vertex long, bucket int, slot long, text_hash long, size long, kept boolean, n_words long, `part` int"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(k, t, "en", None, None if t is None else len(t), *[None] * 9) for k, t in AWKWARD]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def norm(rows):
    """Rows as comparable, sorted tuples."""
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))
