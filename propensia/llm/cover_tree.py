"""Near-duplicate embeddings by dual traversal of cover trees.

Vectors of one label are compared by cosine; on unit vectors that is a distance,
``|a - b| = sqrt(2 - 2 cos)``, so cosine >= 0.98 means a distance of at most
t = 0.2. A cover tree has nested levels with halving radii 2, 1, 1/2, ...: the
centres of a level are farther apart than its radius, every vector is within the
radius of one, and a centre stays a centre further down. Nodes remember their
true covering radius. Two nodes p, q are visited together:

* ``|p - q| > R_p + R_q + t``: no pair between them links, the pair is pruned;
* ``|p - q| + R_p + R_q <= t``: all pairs between them link: the sizes are added
  to the counts and one edge joins them, without looking at members;
* else the children of both are paired, at the bottom the vectors themselves.

So the links are exact, and a group of near copies of any size costs counts and
edges in proportion to its members, not to its pairs. Only sums and a forest of
edges leave a task.

How it runs. Vectors equal in label and entries are one vertex with a weight;
which are is decided by a 128-bit digest of the entries. The top of the tree is
built by Spark, level by level: every cell (at first a label) with more than
``cell_rows`` vertices is parted among at most ``fanout`` centres that are farthest
apart in a bounded sample of it; members go to the nearest centre and their
covering radii are aggregates. In a cell within t / 2 of its centre all pairs link;
it is not parted, and counts by its weight. Cells are put side by side into blocks
of about ``visitors`` vertices. A task builds the trees of a block's cells, visits
each with itself, and writes the block to the shared folder: vectors as they came,
ordered by the nodes of the lowest level. Then the blocks of a label meet, ``GROUP``
of them with as many at a time, each pair of groups in one task that reads them
from there: no vector is copied to where it has partners, so disk is a few times the
input whatever the data. Cells farther apart than their radii and t are left out
unread; of the others the lowest nodes are screened by an orthogonal projection to
few dimensions, in which nothing lies farther apart than it does, and only pairs of
nodes that may be near are visited. No cell, label or group of copies has to fit a
task.

Limits: the pruning is as good as the data's intrinsic dimension lets it be.
On noise in 64 dimensions all vectors are about equally far apart and no exact
metric tree prunes much, so work within a label then grows with its square (the
screen makes a pair cheap, not rare).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensia.llm.common import drop_copy, materialize, release, scratch_path, ship
from propensia.llm.components import components
from propensia.llm.pitman_yor import pack, press, smallest, unpress
from propensia.llm.warc import open_store

THRESHOLD = 0.98
CELL_ROWS, VISITORS, FANOUT, SAMPLE = 2048, 8192, 16, 512
#: Distances from dot products err by up to about 3e-8; nothing closer to a bound than this is pruned or taken whole.
SLACK = 1e-6
#: Node pairs looked at in one go.
CHUNK = 1 << 20
#: Blocks that are held at once; dimensions of the screen, whose single precision errs by less than SCREEN_SLACK.
GROUP, SCREEN, SCREEN_SLACK = 8, 16, 1e-4


class Tree:
    """A cover tree of unit vectors (rows of ``x``) down to nodes of radius ``least``.

    Level i has radius 2 / 2**i. Arrays per level: ``centre`` (row of x),
    ``radius`` (of all members), ``first`` and ``last`` (children in the next
    level), ``lo`` and ``hi`` (members in ``order``), ``weight`` (of members).
    """

    def __init__(self, x: np.ndarray, weight: np.ndarray, least: float):
        self.x, n = x, len(x)
        near = np.zeros(n, dtype=np.int64)  # place of each row's centre
        gap = _distance(x, x[0])
        centres, levels = [0], []
        radius = 2.0
        while radius > least and gap.max(initial=0.0) > 0.0:
            radius /= 2
            parents, above = list(range(len(centres))), near.copy()  # a centre stays one
            while True:
                far = int(np.argmax(gap))
                if gap[far] <= radius:
                    break
                parents.append(int(above[far]))
                own = _distance(x, x[far])
                closer = own < gap
                near[closer], gap[closer] = len(centres), own[closer]
                centres.append(far)
            levels.append(parents)
        self._arrange(centres, levels, near, weight)

    def _arrange(self, centres: list[int], levels: list[list[int]], near: np.ndarray, weight: np.ndarray) -> None:
        """Lay the nodes out so that children and members are ranges."""
        chains = [near]  # place of each row's ancestor, from the bottom level to the top
        for parents in reversed(levels):
            up = np.array(parents, dtype=np.int64)
            chains.append(up[chains[-1]])
        chains.reverse()
        # Members sorted by their ancestors, top first: every node is a range of them.
        self.order = np.lexsort(chains[::-1])
        self.members = self.x[self.order]
        self.weights = weight[self.order]
        total = np.concatenate([[0], np.cumsum(self.weights)])
        self.levels = []
        places, back = np.array(centres, dtype=np.int64), np.empty(len(near), dtype=np.int64)
        back[self.order] = np.arange(len(near))
        starts_below = None
        for chain in reversed(chains):
            own = chain[self.order]
            lo = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            hi = np.append(lo[1:], len(own))
            centre = self.x[places[own[lo]]]
            spread = _rows_distance(self.members, np.repeat(centre, hi - lo, axis=0))
            spread[back[places[own[lo]]]] = 0.0  # of a centre itself
            if starts_below is None:
                self.place = back[places[own[lo]]]  # of the lowest centres among the members
            node = {"centre": centre, "lo": lo, "hi": hi, "radius": np.maximum.reduceat(spread, lo), "weight": total[hi] - total[lo]}
            if starts_below is not None:
                node["first"] = np.searchsorted(starts_below, lo)
                node["last"] = np.append(node["first"][1:], len(starts_below))
            starts_below = lo
            self.levels.append(node)
        self.levels.reverse()


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y), 0.0))


def _rows_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", x, y), 0.0))


class Links:
    """Weighted link counts and a forest over vertices 0 .. n-1."""

    def __init__(self, n: int):
        self.count = np.zeros(n, dtype=np.int64)
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the components of each a and b."""
        if len(a) > 4 * len(self.root):  # one pair of each vertex first: few of the others are left
            for u, v in ((a, b), (b, a)):
                last = np.full(len(self.root), -1)
                last[u] = v
                some = np.flatnonzero(last >= 0)
                self.join(some, last[some])
            root = self.find(np.arange(len(self.root)))
            apart = root[a] != root[b]
            a, b = a[apart], b[apart]
        while True:
            x, y = self.find(a), self.find(b)
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))

    def find(self, v: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[v]
            if (up == v).all():
                return v
            self.root[v] = self.root[up]
            v = up


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0] .. hi[0]-1, lo[1] .. hi[1]-1, ... in one array."""
    n = hi - lo
    return np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def dual(
    a: Tree, b: Tree, at_a: np.ndarray, at_b: np.ndarray, links: Links, threshold: float, pairs: tuple[np.ndarray, np.ndarray] | None = None
) -> None:
    """Add all links between members of ``a`` and of ``b`` (``a is b``: within it, each pair once).

    ``at_a``, ``at_b``: the vertex of each member of a tree, in its order.
    ``pairs``: of trees of one level, the pairs of nodes to visit (else: from the top).
    """
    t = float(np.sqrt(2.0 - 2.0 * threshold))
    same = a is b
    depth = max(len(a.levels), len(b.levels))

    def level(tree: Tree, i: int) -> dict:
        return tree.levels[min(i, len(tree.levels) - 1)]

    def flood(tree: Tree, at: np.ndarray, node: dict, which: np.ndarray) -> None:
        """Join all members of nodes, which are linked by one partner."""
        which = np.flatnonzero(np.bincount(which, minlength=1))
        which = which[node["hi"][which] - node["lo"][which] > 1]
        lo, hi = node["lo"][which], node["hi"][which]
        links.join(at[np.repeat(lo, hi - lo)], at[_ranges(lo, hi)])

    def whole(i: int, p: np.ndarray, q: np.ndarray) -> None:
        """All pairs between the nodes p and q of level i link."""
        x, y = level(a, i), level(b, i)
        itself = (p == q) if same else np.zeros(len(p), dtype=bool)
        to_p = np.bincount(p, weights=y["weight"][q], minlength=len(x["lo"])).astype(np.int64)
        to_q = np.bincount(q[~itself], weights=x["weight"][p[~itself]], minlength=len(y["lo"])).astype(np.int64)
        for tree, at, node, more, which in ((a, at_a, x, to_p, p), (b, at_b, y, to_q, q)):
            got = np.flatnonzero(more)
            lo, hi = node["lo"][got], node["hi"][got]
            members = _ranges(lo, hi)
            np.add.at(links.count, at[members], np.repeat(more[got], hi - lo))
            flood(tree, at, node, which)
        own = p[itself]  # a vertex is no link of itself
        members = _ranges(x["lo"][own], x["hi"][own])
        np.add.at(links.count, at_a[members], -a.weights[members])
        links.join(at_a[x["lo"][p]], at_b[y["lo"][q]])

    def leaves(i: int, p: np.ndarray, q: np.ndarray) -> None:
        """Compare the members of the bottom nodes p and q."""
        x, y = level(a, i), level(b, i)
        for k in range(len(p)):
            r, s = slice(x["lo"][p[k]], x["hi"][p[k]]), slice(y["lo"][q[k]], y["hi"][q[k]])
            near = a.members[r] @ b.members[s].T >= threshold
            itself = same and p[k] == q[k]
            if itself:
                near = np.triu(near, 1)
            u, v = np.nonzero(near)
            if len(u):
                u, v = u + r.start, v + s.start
                np.add.at(links.count, at_a[u], b.weights[v])
                np.add.at(links.count, at_b[v], a.weights[u])
                links.join(at_a[u], at_b[v])

    def singles(i: int, p: np.ndarray, q: np.ndarray) -> None:
        """Bottom nodes; those of one member each are compared together."""
        x, y = level(a, i), level(b, i)
        one = (x["hi"][p] - x["lo"][p] == 1) & (y["hi"][q] - y["lo"][q] == 1)
        leaves(i, p[~one], q[~one])
        u, v = x["lo"][p[one]], y["lo"][q[one]]
        near = np.einsum("ij,ij->i", a.members[u], b.members[v]) >= threshold
        near &= (u != v) if same else True
        u, v = u[near], v[near]
        np.add.at(links.count, at_a[u], b.weights[v])
        np.add.at(links.count, at_b[v], a.weights[u])
        links.join(at_a[u], at_b[v])

    def settle(i: int, p: np.ndarray, q: np.ndarray, gap: np.ndarray) -> None:
        """Prune, take whole, or go down from the pairs p, q of level i at distance gap."""
        x, y = level(a, i), level(b, i)
        reach = x["radius"][p] + y["radius"][q]
        keep = gap <= reach + t + SLACK
        p, q, gap, reach = p[keep], q[keep], gap[keep], reach[keep]
        # Two members of one node are at most two radii apart.
        inside = gap + reach <= t - SLACK
        whole(i, p[inside], q[inside])
        p, q = p[~inside], q[~inside]
        if not len(p):
            return
        if i == depth - 1:
            for at in range(0, len(p), CHUNK >> 4):
                singles(i, p[at : at + (CHUNK >> 4)], q[at : at + (CHUNK >> 4)])
            return
        descend(i, p, q)

    def children(tree: Tree, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Range of the nodes of level i + 1 below each of level i (of a finished tree: itself)."""
        node = level(tree, i)
        if i >= len(tree.levels) - 1:
            own = np.arange(len(node["lo"]))
            return own, own + 1
        return node["first"], node["last"]

    def descend(i: int, p: np.ndarray, q: np.ndarray) -> None:
        x, y = level(a, i + 1), level(b, i + 1)
        (fa, la), (fb, lb) = children(a, i), children(b, i)
        na, nb = la[p] - fa[p], lb[q] - fb[q]
        size = na * nb
        big = np.flatnonzero(size > 4096)
        for k in big:  # one pair with many children: a dense block
            right = np.arange(fb[q[k]], lb[q[k]])
            step = max(1, CHUNK // len(right))
            for lo in range(fa[p[k]], la[p[k]], step):
                left = np.arange(lo, min(lo + step, la[p[k]]))
                gap = np.sqrt(np.maximum(2.0 - 2.0 * (x["centre"][left] @ y["centre"][right].T), 0.0))
                found = gap <= x["radius"][left][:, None] + y["radius"][right][None, :] + t + SLACK
                if same and p[k] == q[k]:
                    found &= left[:, None] <= right[None, :]
                u, v = np.nonzero(found)
                settle(i + 1, left[u], right[v], gap[u, v])
        small = np.flatnonzero(size <= 4096)
        ends = np.cumsum(size[small])
        at = 0
        while at < len(small):  # many pairs with few children: gathered
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (CHUNK >> 3), side="right")))
            k = small[at:stop]
            which = np.repeat(np.arange(len(k)), size[k])
            offset = np.arange(len(which)) - np.repeat(np.cumsum(size[k]) - size[k], size[k])
            u = fa[p[k]][which] + offset // nb[k][which]
            v = fb[q[k]][which] + offset % nb[k][which]
            if same:
                once = (p[k][which] != q[k][which]) | (u <= v)
                u, v = u[once], v[once]
            settle(i + 1, u, v, _rows_distance(x["centre"][u], y["centre"][v]))
            at = stop

    if pairs is None:
        top = np.zeros(1, dtype=np.int64)
        pairs = top, top
    p, q = pairs
    settle(0, p, q, _rows_distance(a.levels[0]["centre"][p], b.levels[0]["centre"][q]))


class Block:
    """The lowest nodes of several cells' trees as a tree of one level.

    ``members`` and ``weights`` by node; ``name`` of each cell, ``cell`` of each node,
    ``ball``: centre and radius of all members of each cell.
    """

    def __init__(self, members: np.ndarray, weights: np.ndarray, lo: np.ndarray, place: np.ndarray, radius: np.ndarray, cell: np.ndarray, name: list[str]):
        hi = np.append(lo[1:], len(members))
        total = np.concatenate([[0], np.cumsum(weights)])
        self.members, self.weights, self.place, self.cell, self.name = members, weights, place, cell, name
        self.levels = [{"centre": members[place], "lo": lo, "hi": hi, "radius": radius, "weight": total[hi] - total[lo]}]
        self.nodes = np.searchsorted(cell, np.arange(len(name) + 1))
        self.ball = balls(members, np.append(lo, len(members))[self.nodes])
        self.low = _screen(self.levels[0]["centre"])

    @classmethod
    def of_trees(cls, trees: list[Tree], names: list[str]) -> Block:
        ends = np.cumsum([0] + [len(tree.members) for tree in trees])
        lowest = [tree.levels[-1] for tree in trees]
        lo = np.concatenate([node["lo"] + at for node, at in zip(lowest, ends)])
        place = np.concatenate([tree.place + at for tree, at in zip(trees, ends)])
        cell = np.repeat(np.arange(len(trees)), [len(node["lo"]) for node in lowest])
        join = lambda what: np.concatenate([getattr(tree, what) for tree in trees])
        return cls(join("members"), join("weights"), lo, place, np.concatenate([node["radius"] for node in lowest]), cell, names)


def balls(members: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A centre and the radius around it of each run of members."""
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        centre = members[a:b].mean(axis=0)
        size = np.linalg.norm(centre)
        centre = centre / size if size > 1e-9 else members[a]
        out.append(np.append(centre, _distance(members[a:b], centre).max() + SLACK))
    return np.array(out)


def apart(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """Which balls of ``a`` and of ``b`` have no members within t of each other."""
    gap = np.sqrt(np.maximum(2.0 - 2.0 * (a[:, :-1] @ b[:, :-1].T), 0.0))
    return gap > a[:, -1][:, None] + b[:, -1][None, :] + t + SLACK


def _screen(x: np.ndarray) -> np.ndarray:
    """Rows u of ``x`` projected, with what makes u . v' of them minus half their squared distance."""
    dims = x.shape[1]
    if dims > SCREEN:
        axes, _ = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, SCREEN)))
        x = x @ axes
    half = -0.5 * np.einsum("ij,ij->i", x, x)
    return np.column_stack([x, half, np.ones(len(x))]).astype(np.float32)


def across(a: Block, b: Block, links: Links, threshold: float, at_a: np.ndarray, at_b: np.ndarray) -> None:
    """Add all links between members of ``a`` and of ``b`` that lie in different cells (``a is b``: each pair once)."""
    t = float(np.sqrt(2.0 - 2.0 * threshold))
    near = ~apart(a.ball, b.ball, t)
    near &= np.array(a.name, dtype=object)[:, None] != np.array(b.name, dtype=object)[None, :]
    if a is b:
        near = np.triu(near, 1)
    right = b.low.copy()
    right[:, -2:] = b.low[:, :-3:-1]
    x, y = a.levels[0]["radius"], b.levels[0]["radius"]

    def kinds(block: Block, cells: np.ndarray, radius: np.ndarray) -> list[np.ndarray]:
        """Nodes of one vector, and others."""
        nodes = _ranges(block.nodes[cells], block.nodes[cells + 1])
        return [nodes[radius[nodes] == 0.0], nodes[radius[nodes] > 0.0]]

    for cell in np.flatnonzero(near.any(axis=1)):
        others = kinds(b, np.flatnonzero(near[cell]), y)
        for p in kinds(a, np.array([cell]), x):
            for q in others:
                if not (len(p) and len(q)):
                    continue
                reach = x[p].max() + y[q].max() + t
                least, there = np.float32(-0.5 * reach * reach - SCREEN_SLACK), right[q].T
                step = max(1, CHUNK // len(q))
                for lo in range(0, len(p), step):
                    likeness = a.low[p[lo : lo + step]] @ there
                    if likeness.max() >= least:
                        u, v = np.nonzero(likeness >= least)
                        dual(a, b, at_a, at_b, links, threshold, (p[lo + u], q[v]))


# ---- the top of the tree, by Spark ----


def vertices(vectors: DataFrame, *, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame, str]:
    """Rows with id, space, digest; vertices with v, w, id, space, digest, x; where these are written.

    ``space`` names what is compared with each other: label and length. It is
    null, as ``digest`` then is, where a vector links with nothing. ``x`` are the
    entries as bytes, in single precision if they came so.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    kind = "float" if single else "double"
    entries = F.transform(F.col(vector).cast(f"array<{kind}>"), lambda c: c + F.lit(0.0).cast(kind))  # -0.0 becomes 0.0
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = F.col(label).isNotNull() & (F.size(entries) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(entries, lambda c: c != 0)
    space = F.concat(F.size(entries).cast("string"), F.lit("|"), F.col(label).cast("string"))
    rows = vectors.select(F.col(key).alias("id"), F.when(whole, space).alias("space"), F.when(whole, entries).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            column = batch.column("entries")
            flat = memoryview(column.flatten().to_numpy(zero_copy_only=False)).cast("B")
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy()) * (4 if single else 8)
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            x = [flat[lo:hi] if ok else None for lo, hi, ok in zip([0, *ends.tolist()], ends.tolist(), valid.tolist())]
            digest = [None if e is None else hashlib.blake2b(e, digest_size=16).digest() for e in x]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(digest, pa.binary()), pa.array(x, pa.binary())], names=["id", "space", "digest", "x"])

    ship(spark)
    name = rows.schema["id"].dataType.simpleString()
    raw, raw_path = _written(rows.mapInArrow(run, f"id {name}, space string, digest binary, x binary"), "vectors")
    grouped = raw.filter("space is not null").groupBy("space", "digest").agg(F.count("*").alias("w"), F.min("id").alias("id"), F.min("x").alias("x"))
    points, path = _written(grouped.select(F.monotonically_increasing_id().alias("v"), "w", "id", "space", "digest", "x"), "vertices")
    rows = materialize(raw.select("id", "space", "digest"), "rows")
    drop_copy(spark, raw_path)
    release(spark)
    return rows, points, path


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), path


def _units(values: list[bytes], dims: int) -> np.ndarray:
    """Entries as bytes, in single or double precision, as unit vectors in double."""
    if not values:
        return np.zeros((0, dims))
    x = np.frombuffer(b"".join(values), "<f4" if len(values[0]) == 4 * dims else "<f8").reshape(-1, dims).astype(float)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _blocks(rows: DataFrame, heads: DataFrame, per_block: int) -> DataFrame:
    """``rows`` dealt by cell and block, each block after a copy of its cell's head.

    ``heads``: (space, cell, many, info); ``many`` rows of the cell make the
    number of blocks, so a cell of any size is spread.
    """
    count = F.greatest(F.lit(1), F.ceil(F.col("many") / per_block)).cast("int")
    sized = rows.join(heads.select("space", "cell", count.alias("blocks")), ["space", "cell"])
    block = F.pmod(F.xxhash64("v", F.lit(7)), F.col("blocks")).cast("int")
    own = sized.select("space", "cell", block.alias("block"), F.lit(None).cast("binary").alias("info"), "v", "w", "x")
    none = [F.lit(None).cast("long").alias("v"), F.lit(None).cast("long").alias("w"), F.lit(None).cast("binary").alias("x")]
    first = heads.select("space", "cell", F.explode(F.sequence(F.lit(0), count - 1)).alias("block"), "info", *none)
    dealt = first.unionByName(own).repartition("space", "cell", "block")
    return dealt.sortWithinPartitions("space", "cell", "block", F.col("v").asc_nulls_first())


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, its rows) of a stream sorted by its first ``keys`` columns."""
    now, parts = None, []
    for batch in batches:
        names = list(zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True))
        at = 0
        while at < len(names):
            stop = at + 1
            while stop < len(names) and names[stop] == names[at]:
                stop += 1
            if names[at] != now:
                if parts:
                    yield now, pa.Table.from_batches(parts)
                now, parts = names[at], []
            parts.append(batch.slice(at, stop - at))
            at = stop
    if parts:
        yield now, pa.Table.from_batches(parts)


def _dims(space: str) -> int:
    return int(space.split("|", 1)[0])


def spread_out(candidates: np.ndarray, most: int, radius: float) -> np.ndarray:
    """Rows that are farthest apart, the first always among them, until ``radius`` covers all or there are ``most``."""
    chosen, gap = [0], _distance(candidates, candidates[0])
    while len(chosen) < most and gap.max() > radius:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, _distance(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def _assign(dealt: DataFrame) -> DataFrame:
    """Members with the number of their nearest centre and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (space, _, _), group in _groups(batches, 3):
            if group.num_rows < 2:
                continue
            centres = np.frombuffer(group.column("info")[0].as_py()).reshape(-1, _dims(space))
            rows = group.slice(1)
            x = _units(rows.column("x").to_pylist(), _dims(space))
            near = np.argmax(x @ centres.T, axis=1)
            gap = _rows_distance(x, centres[near])
            columns = [rows.column(c).combine_chunks() for c in ("space", "cell", "v", "w")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(near.astype(np.int32)), pa.array(gap), rows.column("x").combine_chunks()], names=["space", "cell", "v", "w", "child", "gap", "x"])

    return dealt.mapInArrow(run, "space string, cell string, v long, w long, child int, gap double, x binary")


FOUND = pa.schema(
    [("v", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("space", pa.string()), ("block", pa.int64()), ("file", pa.string()), ("balls", pa.binary())]
)
FOUND_DDL = "v long, links long, root long, space string, block long, file string, balls binary"


def _found(v: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    """Links of vertices and edges to their roots."""
    got = np.flatnonzero((links != 0) | (root != np.arange(len(root))))
    none = [pa.nulls(len(got), f.type) for f in list(FOUND)[3:]]
    return pa.RecordBatch.from_arrays([pa.array(v[got]), pa.array(links[got]), pa.array(v[root[got]]), *none], schema=FOUND)


def _build(dealt: DataFrame, threshold: float, folder: str) -> DataFrame:
    """Links within blocks, and of each block whose space has others the file it is written to."""
    t = float(np.sqrt(2.0 - 2.0 * threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for (space, number), group in _groups(batches, 2):
            raw, names = group.column("x").to_pylist(), np.array(group.column("cell").to_pylist(), dtype=object)
            x, v, w = _units(raw, _dims(space)), group.column("v").to_numpy(), group.column("w").to_numpy()
            ends = np.append(np.flatnonzero(np.append(True, names[1:] != names[:-1])), len(names))
            tight = group.column("tight").to_pylist()
            links, trees = Links(len(x)), []
            for lo, hi in zip(ends[:-1], ends[1:]):
                tree = Tree(x[lo:hi], w[lo:hi], t / 2)
                at = lo + tree.order
                if tight[lo]:
                    links.join(at[1:], np.full(hi - lo - 1, at[0]))
                else:
                    dual(tree, tree, at, at, links, threshold)
                trees.append(tree)
            order = np.concatenate([lo + tree.order for lo, tree in zip(ends[:-1], trees)])
            block = Block.of_trees(trees, names[ends[:-1]].tolist())
            across(block, block, links, threshold, order, order)
            root = links.find(np.arange(len(x)))
            yield _found(v, links.count, root)
            if group.column("many")[0].as_py():
                store, path = open_store(folder)
                path = f"{path}/{uuid.uuid4().hex}"
                back = np.empty(len(order), dtype=np.int64)
                back[order] = np.arange(len(order))
                level = block.levels[0]
                arrays = (v[order], w[order], smallest(level["lo"]), smallest(block.place), level["radius"], smallest(block.cell), smallest(back[root[order]]))
                cells = np.frombuffer("\n".join(block.name).encode(), np.uint8)
                with store.open_output_stream(path) as out:
                    out.write(press(pack(*arrays, cells, np.frombuffer(b"".join(raw[i] for i in order), np.uint8))))
                row = (None, None, None, space, number, path.rsplit("/", 1)[1], block.ball.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, FOUND)], schema=FOUND)

    return dealt.mapInArrow(run, FOUND_DDL)


def _read_block(store, path: str, dims: int) -> tuple[Block, np.ndarray, np.ndarray]:
    """A written block, its vertices and the place of each one's root."""
    with store.open_input_stream(path) as source:
        v, w, lo, place, radius, cell, root, cells, raw = unpress(source.read())
    x = _units([r.tobytes() for r in raw.reshape(len(v), -1)], dims)
    whole = [a.astype(np.int64) for a in (lo, place, cell, root)]
    return Block(x, w, whole[0], whole[1], radius, whole[2], cells.tobytes().decode().split("\n")), v, whole[3]


def _meet(groups: DataFrame, catalog: str, folder: str, threshold: float) -> DataFrame:
    """Links between blocks: each group (space, number, of how many) with itself and half of the others."""
    t = float(np.sqrt(2.0 - 2.0 * threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for r in (r for batch in batches for r in batch.to_pylist()):
            dims, many = _dims(r["space"]), r["groups"]
            store, path = open_store(catalog)
            listed = pq.read_table(path, filesystem=store, filters=[("space", "==", r["space"])]).sort_by("block").to_pylist()
            groups: list[list[dict]] = [[] for _ in range(many)]
            for b in listed:
                groups[b["block"] // GROUP].append(b | {"balls": np.frombuffer(b["balls"]).reshape(-1, dims + 1)})
            store, path = open_store(folder)
            home = [(b["balls"], *_read_block(store, f"{path}/{b['file']}", dims)) for b in groups[r["number"]]]
            counts = [np.zeros(len(v), dtype=np.int64) for _, _, v, _ in home]
            # Of an even number of groups the opposite one is met by the smaller number.
            steps = [k for k in range(1, many // 2 + 1) if 2 * k < many or r["number"] < many // 2]

            def meet(i: int, ball: np.ndarray, other: Block, v: np.ndarray, root: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
                _, block, own, own_root = home[i]  # noqa: B023
                links, n = Links(len(own) + len(v)), len(own)
                links.root = np.concatenate([own_root, root + n])
                began = links.root.copy()
                across(block, other, links, threshold, np.arange(n), n + np.arange(len(v)))
                counts[i] += links.count[:n]  # noqa: B023
                count += links.count[n:]
                roots = np.unique(began)
                moved = roots[links.find(roots) != roots]
                if len(moved):
                    both = np.concatenate([own, v])
                    none = [pa.nulls(len(moved), f.type) for f in list(FOUND)[3:]]
                    yield pa.RecordBatch.from_arrays([pa.array(both[moved]), pa.array(np.zeros(len(moved), np.int64)), pa.array(both[links.find(moved)]), *none], schema=FOUND)

            for i, j in ((i, j) for i in range(len(home)) for j in range(i + 1, len(home))):
                if not apart(home[i][0], home[j][0], t).all():
                    yield from meet(i, *home[j], counts[j])
            for k in steps:
                for b in groups[(r["number"] + k) % many]:
                    partners = [i for i in range(len(home)) if not apart(home[i][0], b["balls"], t).all()]
                    if partners:
                        other, v, root = _read_block(store, f"{path}/{b['file']}", dims)
                        count = np.zeros(len(v), dtype=np.int64)
                        for i in partners:
                            yield from meet(i, b["balls"], other, v, root, count)
                        yield _found(v, count, np.arange(len(v)))
            for (_, _, v, _), count in zip(home, counts):
                yield _found(v, count, np.arange(len(v)))

    return groups.mapInArrow(run, FOUND_DDL)


def near_duplicates(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    cell_rows: int = CELL_ROWS,
    visitors: int = VISITORS,
    fanout: int = FANOUT,
    sample: int = SAMPLE,
) -> DataFrame:
    """key, n_links, component_id and kept of every row.

    Rows link if their labels and lengths are equal and the cosine of their
    vectors, in double precision, is ``threshold`` or more; n_links counts the
    other rows a row links with, component_id is the smallest key reachable.
    Null label, null, empty or zero vector, null or non-finite entries: links
    with nothing. Repeated rows link like any others; rows that share a key are
    rows of their own. Null keys: smaller than none; a component of only such
    has a null component_id and keeps its rows. Empty table: no rows. Other
    columns are not read, whatever their names.

    ``threshold`` lies in [0.5, 1). ``sample`` bounds what centres are chosen
    from; it decides how cells are cut, never what links.
    """
    if not 0.5 <= threshold < 1:
        raise ValueError("threshold must lie in [0.5, 1)")
    spark = vectors.sparkSession
    t = float(np.sqrt(2.0 - 2.0 * threshold))
    rows, points, path = vertices(vectors, key=key, vector=vector, label=label)
    known = materialize(points.select("v", "w", "id", "space", "digest"), "known")
    state, path, cells = _parted(points, path, t, cell_rows, visitors, fanout, sample)
    tight = F.coalesce(F.col("radius") <= (t - SLACK) / 2, F.lit(False))
    # Cells side by side in blocks; a cell of more than a block (all its pairs link) in several.
    before = Window.partitionBy("space").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / visitors)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("n") / visitors))
    laid = cells.select("space", "cell", "n", "weight", tight.alias("tight"), start.alias("start"), pieces.alias("pieces"))
    last = F.max(F.col("start") + F.col("pieces")).over(Window.partitionBy("space"))
    laid = materialize(laid.select("*", last.alias("blocks")), "laid")
    number = (F.col("start") + F.pmod(F.xxhash64("v", F.lit(7)), F.col("pieces"))).cast("long")
    sized = state.join(laid, ["space", "cell"]).select("space", number.alias("block"), "cell", "tight", (F.col("blocks") > 1).alias("many"), "v", "w", "x")
    dealt = sized.repartition("space", "block").sortWithinPartitions("space", "block", "cell", "v")
    folder = scratch_path(spark, "blocks")
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    found = [materialize(_build(dealt, threshold, folder), "found")]
    inside = state.join(laid.filter("tight"), ["space", "cell"]).select("v", "w", "space", "cell", "weight")
    inside = materialize(inside, "inside")
    drop_copy(spark, path)
    release(spark)
    catalog, catalog_path = _written(found[0].filter("file is not null").select("space", "block", "file", "balls"), "catalog")
    groups = catalog.groupBy("space").agg((F.floor(F.max("block") / GROUP) + 1).cast("int").alias("groups"))
    groups = groups.select("space", "groups", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("number"))
    groups = materialize(groups, "groups")
    tasks = min(groups.count(), 100_000)
    if tasks:
        place = F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int")
        found.append(materialize(_meet(groups.coalesce(1).withColumn("place", place).repartitionById(tasks, "place").drop("place"), catalog_path, folder, threshold), "found"))
    drop_copy(spark, folder)
    return _gather(rows, known, found, inside, key)


def _parted(points: DataFrame, path: str, t: float, cell_rows: int, visitors: int, fanout: int, sample: int) -> tuple[DataFrame, str, DataFrame]:
    """Vertices with their cells, where these are written, and the cells: (space, cell, n, weight, radius).

    Each level is one copy of the vertices, and the one before it is deleted.
    """
    spark = points.sparkSession
    state = points.select("space", F.lit("").alias("cell"), "v", "w", "x")
    sizes = state.groupBy("space", "cell").agg(F.count("*").alias("n"), F.sum("w").alias("weight"), F.min_by("x", F.xxhash64("v")).alias("far"))
    cells = materialize(sizes.select("*", F.lit(None).cast("double").alias("radius"), F.lit(None).cast("binary").alias("centre")), "cells")
    level = 0
    while True:
        split = (F.col("n") > cell_rows) & ~F.coalesce(F.col("radius") <= (t - SLACK) / 2, F.lit(False))
        busy = cells.filter(split)
        if busy.isEmpty():
            return state, path, cells
        level += 1
        active = state.join(busy.select("space", "cell", "n"), ["space", "cell"])
        drawn = F.pmod(F.xxhash64("v", F.lit(level)), F.lit(1 << 30)) < F.lit(float(sample) * (1 << 30)) / F.col("n")
        samples = active.filter(drawn).groupBy("space", "cell").agg(F.sort_array(F.collect_list("x")).alias("sample"))
        picked = busy.join(samples, ["space", "cell"], "left").select("space", "cell", "n", "radius", "centre", "far", "sample")
        heads = materialize(_centres(picked, fanout), "centres")
        assigned = _assign(_blocks(active.drop("n"), heads.withColumn("many", F.col("n")), visitors))
        below = F.concat("cell", F.lit("."), F.col("child").cast("string")).alias("cell")
        rest = state.join(cells.filter(~split).select("space", "cell"), ["space", "cell"])
        rest = rest.select("space", "cell", "v", "w", "x", F.lit(None).cast("int").alias("child"), F.lit(None).cast("double").alias("gap"))
        state, after = _written(rest.unionByName(assigned.select("space", below, "v", "w", "x", "child", "gap")), "state")
        drop_copy(spark, path)
        path = after
        release(spark)
        parts = state.filter("child is not null").groupBy("space", "cell", "child").agg(
            F.count("*").alias("n"), F.sum("w").alias("weight"), F.max("gap").alias("radius"), F.max_by("x", "gap").alias("far")
        )
        dims = F.substring_index("space", "|", 1).cast("int") * 8
        own = heads.select("space", F.col("cell").alias("above"), "info", dims.alias("size"))
        parts = parts.withColumn("above", F.expr("substring(cell, 1, length(cell) - length(cast(child as string)) - 1)")).join(own, ["space", "above"])
        parts = parts.select("space", "cell", "n", "weight", "far", "radius", F.expr("substring(info, child * size + 1, size)").alias("centre"))
        cells = materialize(cells.filter(~split).unionByName(parts), "cells")


def _centres(picked: DataFrame, fanout: int) -> DataFrame:
    """(space, cell, n, info): the centres that part a cell, as bytes one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            info = []
            for r in batch.to_pylist():
                dims = _dims(r["space"])
                centre = np.frombuffer(r["centre"] or b"").reshape(-1, dims)
                candidates = np.vstack([centre, _units([r["far"], *(r["sample"] or [])], dims)])
                # All of them in any case: a group of copies stays with one centre, and what is around it goes in few levels.
                info.append(spread_out(candidates, fanout, 0.0 if r["radius"] is None else r["radius"] / 2).tobytes())
            columns = [batch.column(c) for c in ("space", "cell", "n")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(info, pa.binary())], names=["space", "cell", "n", "info"])

    return picked.mapInArrow(run, "space string, cell string, n long, info binary")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _gather(rows: DataFrame, points: DataFrame, found: list[DataFrame], inside: DataFrame, key: str) -> DataFrame:
    """Add up links, with those inside cells where all pairs link, and give every row its links and component."""
    nodes = inside.groupBy("space", "cell").agg(F.min("v").alias("node"))
    inside = inside.join(nodes, ["space", "cell"])
    pairs = _union([f.filter("v is not null").select("v", "links", "root") for f in found])
    counts = pairs.select("v", "links").unionByName(inside.select("v", (F.col("weight") - F.col("w")).alias("links")))
    edges = pairs.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(inside.select(F.col("v").alias("a"), F.col("node").alias("b")))
    links = counts.groupBy("v").agg(F.sum("links").alias("links"))
    roots = components(edges).select(F.col("vertex").alias("v"), "root")
    known = points.join(links, "v", "left").join(roots, "v", "left")
    known = materialize(known.select("w", "id", "space", "digest", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "v").alias("root")), "linked")
    least = known.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = known.join(least, "root").select("space", "digest", (F.col("links") + F.col("w") - 1).alias("n_links"), "component_id")
    linked = rows.filter("space is not null").join(classes, ["space", "digest"]).select("id", "n_links", "component_id")
    alone = rows.filter("space is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
