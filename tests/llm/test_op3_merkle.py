import hashlib
import random
import re

import duckdb
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF0001, SF001
from oracle_check import rows_of
from pyspark.sql import functions as F

from propensia.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_tree(text):
    sections = []
    for section in text.split("\n\n"):
        paragraphs = []
        for p in section.split("\n"):
            leaves = [sha(s) for s in re.sub(r"([.!?]) ", "\\1 \x1f", p).split("\x1f")]
            paragraphs.append((sha("".join(leaves)), leaves))
        sections.append((sha("p" + "".join(h for h, _ in paragraphs)), paragraphs))
    return sha("s" + "".join(h for h, _ in sections)), sections


def test_trees_equal_brute_force(spark, awkward):  # noqa: F811
    rows = merkle.fingerprints(awkward).select("text", "tree").collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        root, sections = brute_tree(r["text"] or "")
        assert r["tree"]["root"] == root
        assert [[(p["hash"], p["sentences"]) for p in s["paragraphs"]] for s in r["tree"]["sections"]] == [
            [(h, leaves) for h, leaves in ps] for _, ps in sections
        ]


def test_root_tells_texts_apart(spark):
    pieces = ["a.", " ", "\n", "\x1f", "b", "! "]
    rng = random.Random(5)
    texts = sorted({"".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(600)})
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(merkle.tree(F.col("text"))["root"].alias("r")).distinct()
    assert rows.count() == len(texts)


def located(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = merkle.locate_edits(rows.select("i", merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b")), "a", "b", "e")
    return [[tuple(x) for x in r["e"]] for r in sorted(rows.select("i", "e").collect())]


def test_edits_are_located(spark):
    old = "One. Two.\nThree.\n\nFour.\nFive.\n\nSix."
    new = "One. Two!\nThree.\n\nFour.\nFive.\nMore.\n\nSix.\n\nSeven."
    ten = "\n".join(f"Line {i}." for i in range(10))
    shifted, gone = "Zero.\n" + ten, ten.replace("Line 4.\n", "")
    carried = "\n".join(f"Line {i}." for i in (0, 1, 7, 2, 3, 4, 5, 6, 8, 9))
    many = "\n\n".join(f"S {i}.\nT {i}." for i in range(6))
    got = located(spark, [(old, new), (old, old), (ten, shifted), (ten, gone), (ten, ten + "\nLine 3."), (ten, carried),
                          ("New.\n\n" + many, many), (many, "\n\n".join(reversed(many.split("\n\n")))), ("A\n\nB", "A\nB"), ("", "x")])
    assert got[0] == [("deleted", 0, 0), ("inserted", 0, 0), ("inserted", 1, 2), ("inserted", 3, 0)]
    assert got[1] == []
    assert got[2] == [("inserted", 0, 0)]
    assert got[3] == [("deleted", 0, 4)]
    assert got[4] == [("inserted", 0, 10)]
    assert got[5] == [("moved", 0, 2), ("moved", 0, 3), ("moved", 0, 8)]
    assert got[6] == [("deleted", 0, 0)]
    assert {k for k, _, p in got[7] if p is None} == {"moved"} and len(got[7]) == 6
    assert got[8] == [("moved", 0, 1)]
    assert got[9] == [("deleted", 0, 0), ("inserted", 0, 0)]


def brute_edits(a, b):
    """The rule of ``edits`` on lists."""

    def number(items):
        return [(x, items[:i].count(x)) for i, x in enumerate(items)]

    def split(x, y):  # items: (key, group); places only in x, only in y, moved in y
        kx, ky = number([k for k, _ in x]), number([k for k, _ in y])

        def chain(items, keys, other):
            kept = [i for i, k in enumerate(keys) if k in other]
            return {i: (keys[kept[n - 1]] if n and items[kept[n - 1]][1] == items[i][1] else None, keys[i]) for n, i in enumerate(kept)}

        cx, cy = chain(x, kx, set(ky)), chain(y, ky, set(kx))
        return [i for i, k in enumerate(kx) if k not in ky], [i for i, k in enumerate(ky) if k not in kx], [i for i, c in cy.items() if c not in cx.values()]

    sa, sb = ([s.split("\n") for s in t.split("\n\n")] for t in (a, b))
    only_a, only_b, moved = split([("\n".join(s), 0) for s in sa], [("\n".join(s), 0) for s in sb])
    pa = [(i, j) for i in only_a for j in range(len(sa[i]))]
    pb = [(i, j) for i in only_b for j in range(len(sb[i]))]
    gone, new, carried = split([(sa[i][j], i) for i, j in pa], [(sb[i][j], i) for i, j in pb])
    return (
        [("deleted", *pa[i]) for i in gone] + [("inserted", *pb[i]) for i in new] + [("moved", *pb[i]) for i in carried] + [("moved", i, None) for i in moved]
    )


def test_edits_equal_a_plain_alignment(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choices(["a.", "b.", "c", "\n", "\n", "\n\n"], k=rng.randint(0, 14)))
        cut = rng.randint(0, len(a))
        b = rng.choice([a[:cut] + rng.choice(["\n", "x", "a.\n", "\n\n"]) + a[cut:], a[cut:] + a[:cut], a[:cut], "".join(rng.sample(a, len(a)))])
        pairs.append((a, b))
    got = located(spark, pairs)
    for (a, b), e in zip(pairs, got):
        assert e == (brute_edits(a, b) if a != b else []), (a, b)
        assert bool(e) == (a != b)


def test_next_texts_over_many_ranges_nulls_and_ties(spark, awkward, nothing):  # noqa: F811
    rows = awkward
    got = merkle.next_texts(rows, rows_per_range=2).collect()
    order = sorted(((k, t or "") for k, t in AWKWARD), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    want = [(k, t, order[(i + 1) % len(order)][1]) for i, (k, t) in enumerate(order)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert merkle.next_texts(nothing).count() == 0
    one = spark.createDataFrame([(4, "only")], "doc_id long, text string")
    assert [tuple(r) for r in merkle.next_texts(one).collect()] == [(4, "only", "only")]


def test_query_equals_its_sql(spark):
    for folder in (SF0001, SF001):
        df = merkle.query(spark, folder)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
        res = con.execute(merkle.ORACLE_SQL)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())
