"""Near-duplicates by a chosen-path set similarity join.

A document is its set of distinct 5-word shingles (64-bit hashes). Copies,
i.e. equal sets, are one vertex from the start. Independent trees branch the
vertices recursively: a node picks, by its own seed, one or two minwise
coordinates (1 / similarity on average, so a pair at the threshold is expected
to meet in one child) and sends every vertex to the children of its tokens
there. Small nodes are compared exhaustively by sketch, larger ones branch
again; ``TREES`` trees make the chance of missing a pair small. Links are
confirmed on full sets.

Large groups of near copies would stay together at every level. Therefore
every node of the first level is first compared with its pivot, one candidate
a member. The pivot is the member that shares tokens with most others over all
nodes: in a group of edited copies that is the text they were edited from,
which is nearer to each of them than they are to each other. Confirmed links
give components, and a node whose members are all of one component needs no
more work, however large.
Only pairs of different components are compared later. In small mixed nodes
the sketches give a spanning forest of the candidates, not their pairs; the
families that it forms over all nodes meet in one task (or, beyond ``BLOCK``
vertices, block by block) together with their full sets, and only links come
out. Nodes that branching doesn't part (a child keeps over half of a large
node, or ``MAX_DEPTH`` is reached) become part of a family as they are.

How it runs: one scan makes ids, first-level tokens and a sketch of 128 bytes
a document, written to the shared folder; tree levels are aggregates and joins
on node numbers, singletons and one-component nodes dropping out at once; full
sets are made again from the texts of candidates only. Hot nodes meet in
skew-aware sort-merge joins; no pair is made within a group that isn't wanted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import materialize, ship, unused
from propensia.llm.components import components

SHINGLE = 5
TREES, ROOT_TOKENS = 12, 16  # four trees have two root branches: 16 / 12 = 1 / 0.75
SKETCH = 128
LEAF = 256  # members of a node that is compared exhaustively
BLOCK = 1024  # vertices of a family that are compared with each other in one task
MAX_DEPTH = 6
REMEMBERED = 1 << 19
P = 0x9E3779B97F4A7C15


def _avalanche(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered per task."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(SHINGLE, len(words))
        with np.errstate(over="ignore"):
            h = w[: len(w) - k + 1] + np.uint64(k)
            for i in range(1, k):
                h = h * np.uint64(P) + w[i : len(w) - k + 1 + i]
        return np.unique(_avalanche(h))


def _multipliers(n: int, seed: int) -> np.ndarray:
    return _avalanche(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(P) + np.uint64(seed)) | np.uint64(1)


TOKEN_SEEDS = _multipliers(ROOT_TOKENS, 1)
SKETCH_SEEDS = (_multipliers(SKETCH, 2) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minwise(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(64-bit minwise token per root coordinate, a byte per sketch coordinate)."""
    tokens = np.full(ROOT_TOKENS, np.iinfo(np.uint64).max, np.uint64)
    sketch = np.full(SKETCH, np.iinfo(np.uint32).max, np.uint32)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    with np.errstate(over="ignore"):
        for low in range(0, len(shingles), 2048):
            part = shingles[low : low + 2048, None]
            np.minimum(tokens, ((part ^ TOKEN_SEEDS) * TOKEN_SEEDS).min(axis=0), out=tokens)
            small = (folded[low : low + 2048, None] ^ SKETCH_SEEDS[::-1]) * SKETCH_SEEDS
            np.minimum(sketch, small.min(axis=0), out=sketch)
        sketch = (sketch * np.uint32(0x85EBCA6B)) >> np.uint32(24)
    return tokens, sketch.astype(np.uint8).tobytes()


def sketch_floor(similarity: float) -> int:
    """Equal sketch bytes below which a pair isn't looked at: over four standard
    deviations under the mean at the threshold."""
    chance = similarity + (1 - similarity) / 256
    return int(SKETCH * chance - 4.2 * (SKETCH * chance * (1 - chance)) ** 0.5)


def signatures(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, vertex (null: no shingle), tokens, sketch per row."""
    ship(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[key].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("vertex", pa.int64()), ("tokens", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            counts, vertices, tokens, sketches = [], [], [], []
            for t in batch.column(1):
                s = shingler(t.as_py())
                counts.append(len(s))
                if len(s):
                    made = minwise(s)
                    vertices.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                    tokens.append(made[0].view(np.int64))
                    sketches.append(made[1])
                else:
                    vertices.append(None)
                    tokens.append(None)
                    sketches.append(None)
            made = zip((counts, vertices, tokens, sketches), list(schema)[2:])
            columns = [batch.column(0).cast(schema[0].type), batch.column(2), *(pa.array(c, f.type) for c, f in made)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, text_hash long, n_shingles long, vertex long, tokens array<long>, sketch binary")


def _close_pairs(pairs: DataFrame, floor: int) -> DataFrame:
    """The pairs (a, b, sketch_a, sketch_b) whose sketches agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH) for i in (2, 3))
                near = pa.array((x == y).sum(axis=1) >= floor)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


class Groups:
    """Union-find over whatever is hashable."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        path = self.parent
        while (up := path.setdefault(x, x)) != x:
            path[x] = x = path[up]
        return x

    def join(self, x, y) -> None:
        path_x, path_y = self.find(x), self.find(y)
        if path_x != path_y:
            self.parent[path_x] = path_y


def _streamed(rows: DataFrame, key: str, body, out: list[str]) -> DataFrame:
    """``body(list of rows)`` -> pairs, for the rows of each key; one key's rows are held."""
    dealt = rows.repartition(key).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        flat = (r for batch in batches for low in range(0, batch.num_rows, 512) for r in batch.slice(low, 512).to_pylist())
        found: list[tuple[int, int]] = []
        for _, group in itertools.groupby(flat, key=lambda r: r[key]):
            found += body(list(group))
            if len(found) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=out)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=out)

    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in out))


def _near(sketches: np.ndarray, i: int, others: np.ndarray, floor: int) -> np.ndarray:
    return others[(sketches[others] == sketches[i]).sum(axis=1) >= floor]


def _families(rows: DataFrame, floor: int) -> DataFrame:
    """Links (a, b) that hold together, in each (small) node, the vertices with
    a partner of another component whose sketch agrees: a spanning forest of
    the candidates, never all pairs. ``rows``: node, vertex, comp, sketch."""

    def forest(group: list[dict]) -> list[tuple[int, int]]:
        if len(group) < 2:
            return []
        comps = np.array([r["comp"] for r in group])
        sketches = np.frombuffer(b"".join(r["sketch"] for r in group), np.uint8).reshape(-1, SKETCH)
        groups, links = Groups(), []
        for i in range(len(group) - 1):
            other = np.flatnonzero(comps[i + 1 :] != comps[i]) + i + 1
            for j in _near(sketches, i, other, floor).tolist():
                if groups.find(i) != groups.find(j):
                    groups.join(i, j)
                    links.append((group[i]["vertex"], group[j]["vertex"]))
        return links

    return _streamed(rows.select("node", "vertex", "comp", "sketch"), "node", forest, ["a", "b"])


def _links_in_families(rows: DataFrame, floor: int, percent: int) -> DataFrame:
    """Confirmed links within families; ``rows``: cell, vertex, comp, side, sketch, s.

    A cell holds one block of a family, or two that are compared with each
    other (side 0 and 1). Pairs of different components whose sketches agree
    are tested on full sets, unless links found before join them already.
    """

    def links(group: list[dict]) -> list[tuple[int, int]]:
        comps = [r["comp"] for r in group]
        sides = np.array([r["side"] for r in group])
        two = sides.min() != sides.max()
        sketches = np.frombuffer(b"".join(r["sketch"] for r in group), np.uint8).reshape(-1, SKETCH)
        sets = [np.frombuffer(r["s"], np.uint64) for r in group]
        groups, out, apart = Groups(), [], np.array(comps)
        for i in range(len(group) - 1):
            other = np.flatnonzero((apart[i + 1 :] != apart[i]) & ((sides[i + 1 :] != sides[i]) | (not two))) + i + 1
            near = [j for j in _near(sketches, i, other, floor).tolist() if groups.find(comps[j]) != groups.find(comps[i])]
            if not near:
                continue
            sizes = np.array([len(sets[j]) for j in near])
            flat = np.concatenate([sets[j] for j in near])
            spot = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            common = np.add.reduceat((sets[i][spot] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            for k in np.flatnonzero(100 * common >= percent * (len(sets[i]) + sizes - common)).tolist():
                if groups.find(comps[near[k]]) != groups.find(comps[i]):
                    groups.join(comps[near[k]], comps[i])
                    out.append((group[i]["vertex"], group[near[k]]["vertex"]))
        return out

    return _streamed(rows.select("cell", "vertex", "comp", "side", "sketch", "s"), "cell", links, ["a", "b"])


def _cells(members: DataFrame, block: int) -> DataFrame:
    """Members (vertex, family, comp) once for each cell of their family: all
    pairs of its blocks of about ``block`` vertices."""
    size = members.groupBy("family").agg(F.count("*").alias("n"))
    m = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("vertex"), F.col("m")).cast("int")
    spread = members.join(size, "family").withColumn("m", m).withColumn("i", own)
    spread = spread.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    cell = F.xxhash64("family", F.least("i", "j"), F.greatest("i", "j"))
    return spread.select(cell.alias("cell"), "vertex", "comp", (F.col("i") > F.col("j")).cast("int").alias("side"))


def _full_sets(vertices: DataFrame, docs: DataFrame, classes: DataFrame, *, key: str, text: str) -> DataFrame:
    """(v, s): full shingle sets of the vertices, made again from their texts; written."""
    wanted = vertices.join(classes.select("vertex", "doc"), "vertex")
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    texts = rows.join(wanted, F.col("k").eqNullSafe(F.col("doc"))).select("vertex", "t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                kept = []
                for v, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    raw = shingler(t).tobytes()
                    if xxhash.xxh3_64_intdigest(raw) - (1 << 63) == v:  # another row of the same key may be another text
                        kept.append((v, raw))
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.binary())], names=["v", "s"])

    return materialize(texts.mapInArrow(sets, "v long, s binary").dropDuplicates(["v"]), "sets")


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, *, key: str, text: str) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""
    vertices = pairs.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    made = _full_sets(vertices, docs, classes, key=key, text=text)
    first = made.select(F.col("v").alias("a"), F.col("s").alias("x"))
    second = made.select(F.col("v").alias("b"), F.col("s").alias("y"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = np.intersect1d(p, q, assume_unique=True).size
                near.append(100 * common >= percent * (len(p) + len(q) - common))
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.mapInArrow(exact, "a long, b long").distinct()


def _branches(node: Column) -> Column:
    """The sketch coordinates (one, or two for every third node) that a node branches on."""
    h = F.xxhash64(F.lit("branch"), node)
    first = F.pmod(h, F.lit(SKETCH)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.shiftright(h, 20), F.lit(SKETCH - 1)).cast("int"), F.lit(SKETCH))
    return F.when(F.pmod(F.shiftright(h, 40), F.lit(3)) == 0, F.array(first, second)).otherwise(F.array(first))


def _split(rows: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members of small, of large and of tight mixed nodes; the rest needs no
    comparison. ``rows``: node, vertex, comp, up (size of the node above, null
    at the first level). A large node with over half of the node above is
    tight: its members are alike and branching doesn't part them."""
    stats = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("up").alias("above"))
    stats = stats.filter("n > 1 and lo <> hi").withColumn("tight", F.coalesce(2 * F.col("n") > F.col("above"), F.lit(False)))
    mixed = materialize(rows.select("node", "vertex", "comp").join(stats.select("node", "n", "tight"), "node"), "nodes")
    small, large = mixed.filter(F.col("n") <= leaf), mixed.filter(F.col("n") > leaf)
    return small, large.filter("not tight"), large.filter("tight")


def link_classes(docs: DataFrame, rows: DataFrame, *, key: str, text: str, percent: int, leaf: int = LEAF, depth: int = MAX_DEPTH, block: int = BLOCK) -> DataFrame:
    """(vertex, root) for every vertex with a link to another; ``rows``: written signatures."""
    floor = sketch_floor(percent / 100)
    best = rows.filter("vertex is not null").groupBy("vertex").agg(F.min("doc_id").alias("doc"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    classes = materialize(best, "classes")
    rooted = classes.select("vertex", F.posexplode("tokens").alias("at", "token")).select("vertex", F.xxhash64(F.col("at") % TREES, "at", "token").alias("node"))
    shared = rooted.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
    sized = materialize(rooted.join(shared, "node"), "sized")
    weights = sized.groupBy("vertex").agg(F.sum("n").alias("weight"))
    weighed = materialize(sized.select("node", "vertex").join(weights, "vertex"), "weighed")
    pivots = weighed.groupBy("node").agg(F.max(F.struct("weight", "vertex")).alias("top")).select("node", F.col("top.vertex").alias("pivot"))
    members = materialize(weighed.select("node", "vertex").join(pivots, "node"), "members")
    sketches = classes.select("vertex", "sketch")

    star = members.filter("vertex <> pivot").select(F.least("pivot", "vertex").alias("a"), F.greatest("pivot", "vertex").alias("b")).distinct()
    star = star.join(sketches.select(F.col("vertex").alias("a"), F.col("sketch").alias("x")), "a")
    star = star.join(sketches.select(F.col("vertex").alias("b"), F.col("sketch").alias("y")), "b").select("a", "b", "x", "y")
    star = materialize(_close_pairs(star, floor), "candidates")
    first = materialize(_confirm(star, docs, classes, percent, key=key, text=text), "links")
    known = materialize(components(first), "components")

    placed = members.select("node", "vertex").join(known.withColumnRenamed("root", "r"), "vertex", "left")
    placed = placed.select("node", "vertex", F.coalesce("r", "vertex").alias("comp"), F.lit(None).cast("long").alias("up"))
    small, large, _ = _split(placed, leaf)
    leaves, whole = [small.select("node", "vertex", "comp")], []
    for _ in range(depth):
        if large.isEmpty():
            break
        grown = large.select("node", "vertex", "comp", "n").join(sketches, "vertex").select("*", F.explode(_branches(F.col("node"))).alias("c"))
        grown = grown.select(F.xxhash64("node", "c", F.expr("substring(sketch, c + 1, 1)")).alias("node"), "vertex", "comp", F.col("n").alias("up"))
        small, large, tight = _split(grown, leaf)
        leaves.append(small.select("node", "vertex", "comp"))
        whole.append(tight.select("node", "vertex"))
    todo = leaves[0]
    for part in leaves[1:]:
        todo = todo.union(part)
    forest = _families(todo.join(sketches, "vertex"), floor)
    rest = large.select("node", "vertex")  # nodes that branching doesn't part hold together as they are
    for part in whole:
        rest = rest.union(part)
    tops = rest.groupBy("node").agg(F.min("vertex").alias("a"))
    forest = forest.union(rest.select("node", F.col("vertex").alias("b")).join(tops, "node").select("a", "b"))
    family = materialize(components(forest), "families").select("vertex", F.col("root").alias("family"))
    comp = known.withColumnRenamed("root", "r")
    members = materialize(family.join(comp, "vertex", "left").select("vertex", "family", F.coalesce("r", "vertex").alias("comp")), "members")
    sets = _full_sets(members.select("vertex").distinct(), docs, classes, key=key, text=text)
    cells = _cells(members, block).join(sketches, "vertex").join(sets.withColumnRenamed("v", "vertex"), "vertex")
    return components(first.union(_links_in_families(cells, floor, percent)))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """key, text_hash, n_shingles, group, component_id (smallest key reachable), kept, per row.

    Null, empty and blank texts: no shingle, linked with nothing, a component
    of their own (null group). Null keys: ignored by the smallest key, unless
    a component has no other. Repeated rows: equal texts are one vertex, so
    all get the same component, and ``kept`` holds for each row with its
    smallest key. Very long texts are taken whole. Empty table: no rows. Extra
    columns are not read.
    """
    rows = materialize(signatures(docs, key=key, text=text), "signatures")
    roots = materialize(link_classes(docs, rows, key=key, text=text, percent=percent), "roots")
    placed = rows.select("doc_id", "text_hash", "n_shingles", "vertex").join(roots, "vertex", "left")
    placed = placed.select("doc_id", "text_hash", "n_shingles", F.coalesce("root", "vertex").alias("group"))
    least = placed.filter("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = placed.join(least, "group", "left").withColumn("component_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select(F.col("doc_id").alias(key), "text_hash", "n_shingles", "group", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component: its smallest key, then the
    smallest hash of the text; rows that repeat key and text count as one.
    Rows without shingles all stay."""
    found = materialize(near_duplicates(docs, key=key, text=text, percent=percent), "components")
    first = found.filter("kept and group is not null").groupBy("group").agg(F.min("text_hash").alias("first_hash"))
    gone = found.filter("group is not null").join(first, "group").filter("not kept or text_hash <> first_hash")
    own, gone_key, gone_hash = (unused(c, docs.columns) for c in ("_text_hash", "_gone_key", "_gone_hash"))
    gone = gone.select(F.col(key).alias(gone_key), F.col("text_hash").alias(gone_hash)).distinct()
    marked = docs.withColumn(own, F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col(gone_key)) & (F.col(own) == F.col(gone_hash))
    stay = marked.join(gone, same, "left_anti")
    again = found.filter("kept and group is not null").groupBy(key, "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    again = materialize(again.select(F.col(key).alias(gone_key), F.col("text_hash").alias(gone_hash)), "repeated")
    if not again.isEmpty():
        once = stay.join(again, same, "left_semi").dropDuplicates([key, own])
        stay = stay.join(again, same, "left_anti").union(once)
    return stay.select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates over all documents."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
