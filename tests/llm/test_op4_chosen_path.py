import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF001

from propensia.llm import chosen_path as cp
from propensia.llm.common import materialize
from propensia.llm.components import components


def shingles(text):
    table = {i: i + 32 for i in range(65, 91)}
    words = "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in (text or "")).translate(table).split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, percent=75):
    """Smallest key reachable by exact links; an inverted index finds them all."""
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    sets, index = [shingles(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in index[x]).items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
        for x in s:
            index[x].append(i)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def result(df):
    rows = df.collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


def corpus(seed, groups, size, changed, words=60, shared=0):
    """Groups of near copies of a base text; ``shared`` words open every text."""
    rng = random.Random(seed)
    opening = [f"common{i}" for i in range(shared)]
    rows = []
    for g in range(groups):
        base = [f"w{g}x{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, changed)):
                text[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(opening + text)))
    rng.shuffle(rows)
    return rows


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000, i) for i in range(1001, 1300)]
    links += [(i, i + 1) for i in range(2000, 2060)] + [(7, 7), (None, 3)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {v: find(v) for v in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows_and_empty_table(spark, awkward, nothing):  # noqa: F811
    assert result(cp.near_duplicates(awkward)) == brute(AWKWARD)
    assert cp.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("case", [dict(groups=30, size=8, changed=3), dict(groups=3, size=150, changed=2), dict(groups=60, size=4, changed=2, shared=25)])
def test_near_copies_equal_brute_force(spark, case):
    rows = corpus(11, **case)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(cp.near_duplicates(docs)) == brute(rows)


def test_large_mixed_nodes_branch_and_meet_in_blocks(spark):
    """Tiny leaves force the recursion and, at depth 1, the blockwise comparison."""
    rows = corpus(5, groups=40, size=3, changed=2, shared=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    signed = materialize(cp.signatures(docs, key="doc_id", text="text"), "test-signatures")
    want = brute(rows)
    for leaf, depth, block in ((8, 10, 1024), (8, 1, 16), (4, 0, 7)):
        linked = cp.link_classes(docs, signed, key="doc_id", text="text", percent=75, leaf=leaf, depth=depth, block=block)
        roots = {r["vertex"]: r["root"] for r in linked.collect()}
        least, placed = {}, []
        for r in signed.collect():
            root = roots.get(r["vertex"], r["vertex"])
            placed.append((r["doc_id"], r["n_shingles"], root))
            least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
        got = sorted(((k, n, least[root]) for k, n, root in placed), key=str)
        assert sum(a != b for a, b in zip(got, want)) <= 2, (leaf, depth)


def test_whole_table_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert result(cp.query(spark, SF001)) == brute(rows)


def test_edited_copies_without_links_make_no_pairs(spark):
    """Copies of one text with many edits are similar but mostly unlinked."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 400):
        text = list(base)
        for _ in range(rng.randint(0, 8)):
            text[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(cp.near_duplicates(docs)) == brute(rows)


def test_threshold_is_exact_on_sets(spark):
    words = [f"u{i}" for i in range(60)]
    rows = [(0, " ".join(words))]
    for i, cut in enumerate(range(1, 20), 1):
        rows.append((i, " ".join(words[:-cut] + [f"v{i}y{j}" for j in range(cut)])))
    pairs = spark.createDataFrame([(0, i) for i in range(1, 20)], "x long, y long")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = materialize(cp.signatures(docs, key="doc_id", text="text"), "test-signatures")
    names = {r["doc_id"]: r["vertex"] for r in signed.collect()}
    classes = signed.selectExpr("vertex", "doc_id as doc")
    pairs = spark.createDataFrame([(names[0], names[i]) for i in range(1, 20)], "a long, b long")
    got = {r["b"] for r in cp._confirm(pairs, docs, classes, 75, key="doc_id", text="text").collect()}
    sets = {k: shingles(t) for k, t in rows}
    want = {names[i] for i in range(1, 20) if 100 * len(sets[0] & sets[i]) >= 75 * len(sets[0] | sets[i])}
    assert got == want and 0 < len(want) < 19


def test_one_row_of_each_group_stays(spark, awkward):  # noqa: F811
    left = cp.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    want, seen = [], set()
    for k, t in sorted(AWKWARD, key=lambda x: (x[0] is None, x[0] or 0)):
        if not (s := shingles(t)) or s not in seen:
            want.append((k, t))
        seen.add(s)
    assert got == sorted(want, key=str)


def test_sketch_agrees_with_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    other = base.copy()
    other[:143] = rng.integers(0, 2**63, 143).astype(np.uint64)  # similarity 857 / 1143 = 0.75
    a, b = (np.frombuffer(cp.minwise(np.unique(x))[1], np.uint8) for x in (base, other))
    assert cp.sketch_floor(0.75) <= (a == b).sum() <= 0.95 * cp.SKETCH


def test_recall_where_every_root_node_is_large(spark):
    """A passage that all texts share makes the common root nodes large: pairs near the
    threshold must be found by branching. Tiny leaves stand for a large table."""
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(70)]
    rows, pairs = [], 400
    for g in range(pairs):
        own = [f"o{g}x{i}" for i in range(60)]
        for _ in range(2):  # three changes of one word each, with no shingle in common
            rows.append((len(rows), " ".join(passage + own)))
            own = [*own[:15], f"c{g}", *own[16:30], f"d{g}", *own[31:45], f"e{g}", *own[46:]]
    sets = [shingles(t) for _, t in rows]
    near = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(rows), 2)]
    assert 0.78 < min(near) and max(near) < 0.79
    assert len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 0.5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    signed = materialize(cp.signatures(docs, key="doc_id", text="text"), "test-signatures")
    linked = cp.link_classes(docs, signed, key="doc_id", text="text", percent=75, leaf=32)
    roots = {r["vertex"]: r["root"] for r in linked.collect()}
    placed = {r["doc_id"]: roots.get(r["vertex"], r["vertex"]) for r in signed.collect()}
    found = sum(placed[i] == placed[i + 1] for i in range(0, len(rows), 2))
    print("recall", found / pairs)
    assert found >= 0.99 * pairs
    assert len({placed[i] for i in range(len(rows))}) == 2 * pairs - found
