"""Cover-tree links against all pairs of a label."""

import math
from collections import defaultdict

import numpy as np
import pytest
from awkward_rows import SF0001, norm
from propensia.llm import cover_tree as ct

SCHEMA = "vec_id long, embedding array<float>, label int, space string, cell string, v long, kept boolean, links long"


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def groups_of_copies(rng, n, dims, centres, spread):
    c = unit(rng.normal(size=(centres, dims)))
    return unit(c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dims)) / math.sqrt(dims))


def brute(rows, threshold=0.98):
    """rows: (vec_id, vector or None, label) -> sorted (vec_id, n_links, component_id, kept)."""

    def usable(r):
        return r[1] is not None and r[2] is not None and len(r[1]) and all(c is not None and math.isfinite(c) for c in r[1]) and any(r[1])

    n = len(rows)
    links = defaultdict(set)
    for i in range(n):
        for j in range(i + 1, n):
            a, b = rows[i], rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], dtype=float), np.array(b[1], dtype=float)
                x, y = x / abs(x).max(), y / abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        component, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - component:
                component.add(j)
                todo.append(j)
        seen |= component
        known = [rows[j][0] for j in component if rows[j][0] is not None]
        least = min(known, default=None)
        for j in component:
            out[j] = (rows[j][0], len(links[j]), least, rows[j][0] == least)
    return norm(out)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA)
    return norm(ct.near_duplicates(frame, **kw).collect())


@pytest.mark.parametrize(
    ("n", "dims", "centres", "spread"),
    [(1, 8, 1, 0.0), (300, 2, 5, 0.3), (800, 64, 800, 0.05), (800, 64, 10, 0.1), (800, 64, 3, 0.15), (800, 3, 7, 0.5), (600, 16, 1, 0.01), (300, 64, 2, 0.0)],
)
def test_dual_traversal_equals_all_pairs(n, dims, centres, spread):
    rng = np.random.default_rng(n + dims)
    x, w = groups_of_copies(rng, n, dims, centres, spread), rng.integers(1, 4, n)
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    tree, links = ct.Tree(x, w, 0.1), ct.Links(n)
    ct.dual(tree, tree, tree.order, tree.order, links, 0.98)
    assert (links.count == near @ w).all()
    half = n // 2
    if half:
        a, b, across = ct.Tree(x[:half], w[:half], 0.1), ct.Tree(x[half:], w[half:], 0.1), ct.Links(n)
        ct.dual(a, b, a.order, b.order + half, across, 0.98)
        near[:half, :half] = near[half:, half:] = False
        assert (across.count == near @ w).all()
        u, v = np.nonzero(near)
        assert (across.find(u) == across.find(v)).all()


def test_tree_is_nested_separated_and_covering():
    rng = np.random.default_rng(3)
    x = groups_of_copies(rng, 500, 8, 40, 0.3)
    tree = ct.Tree(x, np.ones(500, dtype=np.int64), 0.1)
    above = None
    for i, level in enumerate(tree.levels):
        radius = 2.0 / 2**i
        apart = np.sqrt(np.maximum(2 - 2 * level["centre"] @ level["centre"].T, 0))
        np.fill_diagonal(apart, 9.0)
        assert apart.min() > radius or len(apart) == 1
        assert (level["radius"] <= 2 * radius + 1e-9).all()  # the sum of the halving radii below
        names = {c.tobytes() for c in level["centre"]}
        assert above is None or above <= names  # a centre stays a centre
        above = names
        assert level["lo"][0] == 0 and level["hi"][-1] == 500 and (level["lo"][1:] == level["hi"][:-1]).all()


@pytest.mark.parametrize("kw", [{}, {"cell_rows": 12, "visitors": 16, "sample": 12, "fanout": 3}])
def test_cells_and_visitors_equal_all_pairs(spark, kw):
    """One label holds most rows, one tight group most of those; borders of cells run through groups."""
    rng = np.random.default_rng(5)
    hot = np.vstack([groups_of_copies(rng, 60, 6, 4, 0.35), groups_of_copies(rng, 70, 6, 1, 0.05), groups_of_copies(rng, 60, 6, 60, 0.0)])
    other = groups_of_copies(rng, 25, 6, 3, 0.2)
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(hot)] + [(1000 + i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(other)]
    rng.shuffle(rows)
    assert run(spark, [(int(a), b, int(c)) for a, b, c in rows], **kw) == brute(rows)


@pytest.mark.parametrize("kw", [{}, {"cell_rows": 3, "visitors": 4, "sample": 4, "fanout": 2}])
def test_awkward_vectors(spark, kw):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [5.0, 0.0], 0), (4, [-1.0, 0.0], 0), (5, [1.0, -0.0], 0),
        (6, [1.0, 0.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0, 0.0], 0), (9, None, 0), (10, [], 0), (11, [0.0, 0.0], 0),
        (12, [None, 1.0], 0), (13, [inf, 1.0], 0), (14, [nan, 1.0], 0), (None, [0.0, 1.0], 0), (None, [0.0, 1.0], 0), (None, [0.0, 1.0], 0),
        (15, [1e-30, 1e-30], 0), (16, [1e30, 1.1e30], 0), (17, [1.0, 0.19], 0), (18, [1.0, 0.21], 0), (19, [1.0, 0.4], 0), (20, [0.02, 1.0], 0),
    ]
    assert run(spark, rows, **kw) == brute(rows)


def test_empty_table(spark):
    out = ct.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert out.count() == 0


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert norm(ct.query(spark, SF0001).collect()) == brute(rows)


def test_noise_costs_disk_in_proportion_to_its_vectors(spark):
    """Blocks of one label meet in all pairs without a copy of a vector for every cell it may have a partner in."""
    import os

    from propensia.session import checkpoint_dir

    rng = np.random.default_rng(9)
    n = 4000
    x = np.vstack([unit(rng.normal(size=(n - 60, 32))), groups_of_copies(rng, 60, 32, 2, 0.1)]).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = norm(ct.near_duplicates(rows, cell_rows=64, visitors=256, sample=64, fanout=4).collect())
    assert got == brute_by_matrix(x)
    made = [os.path.join(at, f) for d in set(os.listdir(folder)) - before for at, _, files in os.walk(os.path.join(folder, d)) for f in files]
    assert sum(os.path.getsize(f) for f in made) < 6 * x.nbytes


def brute_by_matrix(x, threshold=0.98):
    x = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    least = np.arange(len(x))
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], len(x)).min(axis=1))
        if (lower == least).all():
            return norm([(i, int(k), int(c), i == int(c)) for i, (k, c) in enumerate(zip(near.sum(axis=1), least))])
        least = lower


@pytest.mark.parametrize(("dims", "spread"), [(3, 0.5), (24, 0.1), (64, 0.15)])
def test_blocks_of_cells_equal_all_pairs(dims, spread):
    rng = np.random.default_rng(dims)
    x, w = groups_of_copies(rng, 900, dims, 5, spread), rng.integers(1, 4, 900)
    near = x @ x.T >= 0.98
    home = rng.integers(0, 7, 900)  # cells that overlap
    near[home[:, None] == home[None, :]] = False
    links, blocks, places = ct.Links(900), [], []
    for cells in ([0, 1, 2], [3, 4, 5, 6]):
        rows = [np.flatnonzero(home == c) for c in cells]
        trees = [ct.Tree(x[r], w[r], 0.1) for r in rows]
        blocks.append(ct.Block.of_trees(trees, [str(c) for c in cells]))
        places.append(np.concatenate([r[t.order] for r, t in zip(rows, trees)]))
    for i, j in ((0, 0), (0, 1), (1, 1)):
        ct.across(blocks[i], blocks[j], links, 0.98, places[i], places[j])
    assert (links.count == near @ w).all()
    u, v = np.nonzero(near)
    assert (links.find(u) == links.find(v)).all()
