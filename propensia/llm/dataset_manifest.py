"""Merkle manifest of a dataset: sparse levels kept, the rest recomputed.

Rows are leaves. Per group (a source) the leaves are numbered in key order and
every ``FAN`` consecutive nodes of a level are hashed to one of the next, until
one is left: the subroot. The subroots, in the order of their groups, are the
leaves of one more tree, whose root stands for the whole table.

Only every ``BAND``-th level is stored (0, 3, 6, ...), so a manifest costs
little more than its leaves. Nodes between two stored levels belong to aligned
subtrees of ``FAN ** BAND`` stored nodes. A proof needs the siblings on the path
to the root; extraction goes from the top down: the task that has a subtree's
stored nodes hashes its missing inner nodes anew, emits the siblings of its
nodes together with those it was given from above, and forgets the inner nodes.

How it runs. Leaves are hashed in one scan and written, narrow. Their numbers
come from a range shuffle on (group, key, leaf), running numbers inside the
ranges and a window over one row a (range, group), so a group with a third of
all rows is spread like any other. Building and extraction deal subtrees, not
groups: a task streams over whole subtrees, 4,096 nodes in memory at a time.
What lies above a subtree travels once per subtree, as the first row of its
stream. Nothing but the largest group size reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from propensia.llm.common import materialize, ship

FAN, BAND = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ABOVE = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int, fan: int = FAN) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def leaf(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its byte count, ``:`` and its text."""
    texts = [v.cast("string") for v in values]
    framed = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (written) with ``i``, the number in the group ``g`` in ``order``, and ``n``, the group's size.

    Columns compare ascending with null first, strings by their UTF-8 bytes.
    """
    columns = ["g", *order]
    ranged = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    schema = StructType([*ranged.schema.fields, StructField("part", LongType()), StructField("at", LongType())])
    arrow = to_arrow_schema(schema)
    g_at = ranged.columns.index("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, group, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            numbers = []
            for g in batch.column(g_at).to_pylist():
                group, at = (g, at + 1) if g == group else (g, 0)
                numbers.append(at)
            more = [pa.array([part] * len(numbers), pa.int64()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, *more], arrow, strict=True)], schema=arrow)

    placed = materialize(ranged.mapInArrow(run, schema), "placed")
    counts = placed.groupBy("g", "part").agg(F.count("*").alias("here"))
    mine = Window.partitionBy("g")  # a row a range of the group
    before = F.sum("here").over(mine.orderBy("part")) - F.col("here")
    counts = counts.select("g", "part", before.alias("before"), F.sum("here").over(mine).alias("n"))
    numbered = placed.join(counts, ["g", "part"])
    return numbered.select("n", (F.col("before") + F.col("at")).alias("i"), *rows.columns)


@dataclass(frozen=True)
class Forest:
    """Trees of all groups. ``stored[b]``: level ``band * b`` as (g, n, i, hash), level 0 with ``carry`` too."""

    stored: list[DataFrame]
    carry: list[str]
    fan: int = FAN
    band: int = BAND

    @property
    def subtree(self) -> int:
        return self.fan**self.band

    def heights(self) -> Column:
        """Height of the tree of ``n`` leaves (as many levels as 64 bits can need)."""
        found = F.when(F.col("n") <= 1, 0)
        for level in range(1, height(1 << 62, self.fan)):
            found = found.when(F.col("n") <= self.fan**level, level)
        return found.otherwise(height(1 << 62, self.fan))

    def roots(self) -> DataFrame:
        """(g, n, root) of every group."""
        found = [self.stored[0].filter("n = 1").select("g", "n", F.col("hash").alias("root"))]
        for b, nodes in enumerate(self.stored[1:], 1):
            done = nodes.filter((self.heights() <= self.band * b) & (self.heights() > self.band * (b - 1)))
            found.append(done.select("g", "n", F.col("hash").alias("root")))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((g, tree), its rows) of a stream sorted by g and tree; columns g, tree first."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != now:
                if rows:
                    yield now, rows
                now, rows = row[:2], []
            rows.append(row)
    if rows:
        yield now, rows


def _levels(hashes: list[str], steps: int, fan: int) -> list[list[str]]:
    """The stored nodes of a subtree and its inner levels above them, hashed anew."""
    levels = [hashes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([digest("".join(below[at : at + fan])) for at in range(0, len(below), fan)])
    return levels


def _dealt(nodes: DataFrame, subtree: int) -> DataFrame:
    """Nodes by whole subtrees, in order; columns g, tree and the others."""
    tree = F.floor(F.col("i") / subtree) if "tree" not in nodes.columns else F.col("tree")
    rest = [c for c in nodes.columns if c not in ("g", "tree")]
    dealt = nodes.select("g", tree.cast("long").alias("tree"), *rest)
    return dealt.repartition("g", "tree").sortWithinPartitions("g", "tree", "i")


def grow(rows: DataFrame, order: Sequence[str], *, fan: int = FAN, band: int = BAND) -> Forest:
    """The forest of ``rows``: columns g (string, not null), hash and any to carry along.

    Leaves of a group are numbered by ``order``. Empty table: a forest without nodes.
    """
    ship(rows.sparkSession)
    carry = [c for c in rows.columns if c not in ("g", "hash")]
    stored = [materialize(_numbered(rows, order).select("g", "n", "i", "hash", *carry), "manifest-0")]
    largest = stored[0].agg(F.max("n")).first()[0] or 0
    top = height(largest, fan)
    schema = StructType([StructField("g", StringType()), StructField("n", LongType()), StructField("i", LongType()), StructField("hash", StringType())])
    arrow = to_arrow_schema(schema)
    for base in range(0, top, band):
        nodes = stored[-1].select("g", "n", "i", "hash").filter(Forest(stored, carry, fan, band).heights() > base)

        def run(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
            made: list[tuple] = []
            for (g, tree), members in _subtrees(batches):
                n = members[0][2]
                steps = min(band, height(n, fan) - base)
                made.append((g, n, tree, _levels([m[4] for m in members], steps, fan)[-1][0]))
                if len(made) >= 4096:
                    yield _batch(made, arrow)
                    made = []
            if made:
                yield _batch(made, arrow)

        stored.append(materialize(_dealt(nodes, fan**band).mapInArrow(run, schema), f"manifest-{base + band}"))
    return Forest(stored, carry, fan, band)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


#: (leaf, its group's size, its carried values, siblings (left, right) from its level to the root) -> row
Emit = Callable[[str, int, tuple, list[tuple[str, str]]], tuple]


def extract(forest: Forest, seeds: DataFrame, emit: Emit, schema: StructType) -> DataFrame:
    """A row ``emit`` makes for every leaf, from its carried values and its siblings up to the root.

    ``seeds``: (g, above), what lies above each group's subroot. Levels are
    visited from the top; inner nodes of a subtree live only in its task.
    """
    fan, band = forest.fan, forest.band
    given = None  # (g, tree, above) of the subtrees of the band below
    middle = StructType([StructField("g", StringType()), StructField("tree", LongType()), StructField("above", _type(ABOVE))])
    sizes = forest.roots().select("g", "n").join(seeds, "g")
    for b in range(max(len(forest.stored) - 2, 0), -1, -1):
        base = band * b
        low, high = (base, base + band) if b else (-1, band)
        ends = sizes.filter((forest.heights() > low) & (forest.heights() <= high)).select("g", F.lit(0).cast("long").alias("tree"), "above")
        heads = ends if given is None else given.unionByName(ends)
        nodes = forest.stored[b].filter(forest.heights() > base) if b else forest.stored[0]
        carry = forest.carry if b == 0 else []
        nodes = nodes.select("g", F.floor(F.col("i") / forest.subtree).cast("long").alias("tree"), "n", "i", "hash", F.lit(None).cast(ABOVE).alias("above"), *carry)
        blank = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in ("n", "hash")]
        heads = heads.select("g", "tree", blank[0], F.lit(-1).cast("long").alias("i"), blank[1], "above", *(F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in carry))
        out = schema if b == 0 else middle
        arrow = to_arrow_schema(out)
        make = emit if b == 0 else None

        def run(batches: Iterator[pa.RecordBatch], base: int = base, arrow: pa.Schema = arrow, make: Emit | None = make) -> Iterator[pa.RecordBatch]:
            made: list[tuple] = []
            for (g, _), rows in _subtrees(batches):
                above = [(s["left"], s["right"]) for s in rows[0][5]]
                members = rows[1:]
                steps = max(0, min(band, height(members[0][2], fan) - base))
                levels = _levels([m[4] for m in members], steps, fan)
                shared: dict[tuple[int, int], list[tuple[str, str]]] = {}  # siblings from a level's node upwards

                def path(level: int, at: int) -> list[tuple[str, str]]:
                    if level == steps:
                        return above
                    if (level, at) not in shared:
                        first = at // fan * fan
                        run = levels[level]
                        own = ("".join(run[first:at]), "".join(run[at + 1 : first + fan]))
                        found = [own, *path(level + 1, at // fan)]
                        if level == 0:
                            return found
                        shared[level, at] = found
                    return shared[level, at]

                for at, m in enumerate(members):
                    siblings = path(0, at)
                    if make:
                        made.append(make(m[4], m[2], m[6:], siblings))
                    else:
                        made.append((g, m[3], [{"left": x, "right": y} for x, y in siblings]))
                    if len(made) >= 2048:
                        yield _batch(made, arrow)
                        made = []
            if made:
                yield _batch(made, arrow)

        found = _dealt(nodes.unionByName(heads), forest.subtree).mapInArrow(run, out)
        if b:
            given = materialize(found, f"paths-{base}")
    return found


def _type(ddl: str):
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def fold(node: str, siblings: list[tuple[str, str]]) -> tuple[str, ...]:
    """Hashes of the ancestors of ``node``, the root last (of a lone leaf: itself)."""
    out = [node]
    for left, right in siblings:
        out.append(digest(left + out[-1] + right))
    return tuple(out)


@dataclass(frozen=True)
class Manifest:
    """Trees of the groups and the tree over their subroots; ``key`` and ``probe`` go with each leaf."""

    groups: Forest
    top: Forest

    def root(self) -> str | None:
        """The hash of the whole table; None for a table without rows."""
        found = self.top.roots().first()
        return found["root"] if found else None

    def _seeds(self) -> DataFrame:
        """(g, above): the siblings above each group's subroot."""
        schema = StructType([StructField("g", StringType()), StructField("above", _type(ABOVE))])
        start = self.top.roots().select("g", F.array().cast(ABOVE).alias("above"))

        def emit(node: str, n: int, carried: tuple, siblings: list[tuple[str, str]]) -> tuple:
            return (carried[0], [{"left": x, "right": y} for x, y in siblings])

        return materialize(extract(self.top, start, emit, schema), "seeds")

    def _key(self) -> StructField:
        return self.groups.stored[0].schema["key"]

    def proofs(self) -> DataFrame:
        """key, leaf and ``siblings`` (left and right of the path, from the leaf's level to the root) of every row."""
        schema = StructType([self._key(), StructField("leaf", StringType()), StructField("siblings", _type(ABOVE))])

        def emit(node: str, n: int, carried: tuple, siblings: list[tuple[str, str]]) -> tuple:
            return (carried[0], node, [{"left": x, "right": y} for x, y in siblings])

        return extract(self.groups, self._seeds(), emit, schema)

    def verify(self) -> DataFrame:
        """key, leaf, subroot, root, digest of the proof, and the root folded from the row's ``probe`` and its proof."""
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        schema = StructType([self._key(), *(StructField(c, StringType()) for c in names)])
        fan = self.groups.fan

        def emit(node: str, n: int, carried: tuple, siblings: list[tuple[str, str]]) -> tuple:
            key, probe = carried
            path = fold(node, siblings)
            proof = digest("".join(chain.from_iterable(siblings)))
            return (key, node, path[height(n, fan)], path[-1], proof, fold(probe, siblings)[-1])

        return extract(self.groups, self._seeds(), emit, schema)


def build(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    probe: Column | None = None,
    fan: int = FAN,
    band: int = BAND,
) -> Manifest:
    """The manifest of ``docs``.

    A leaf frames ``fields`` in their order. Null in any field: ``-``; null
    group: a group of its own, before all others; null key: before all others.
    Tied keys are ordered by leaf; repeated rows are leaves of their own. Empty
    and very long texts are framed whole. Empty table: no leaves and no root.
    Columns other than ``fields``, ``key`` and ``group`` are not read, whatever
    their names. ``probe``: the leaf that verification folds (default: the
    row's own), an expression over the columns of ``docs``.
    """
    own = leaf([F.col(c) for c in fields])
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    # probe is null where it is the row's own leaf, so that a text is hashed once
    rows = docs.select(g.alias("g"), own.alias("hash"), F.col(key).alias("key"), (F.lit(None).cast("string") if probe is None else probe).alias("other"))
    rows = materialize(rows, "leaves").select("g", "hash", "key", F.coalesce("other", "hash").alias("probe"))
    groups = grow(rows, ["key", "hash"], fan=fan, band=band)
    subroots = groups.roots().select(F.lit("").alias("g"), F.col("root").alias("hash"), F.col("g").alias("name"))
    return Manifest(groups, grow(materialize(subroots, "subroots"), ["name"], fan=fan, band=band))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, every fifth one (by crc32 of its id) with its text lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = leaf([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = build(docs, probe=F.when(changed, tampered)).verify()
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _tree_sql(name: str, leaves: str) -> str:
    """CTE ``name`` (g, level, i, n, h): all nodes of the trees over ``leaves`` (g, i, h)."""
    return f"""{name} AS (
  SELECT g, 0 AS level, i, count(*) OVER (PARTITION BY g) AS n, h FROM {leaves}
  UNION ALL
  SELECT g, level + 1, i // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1
  GROUP BY g, level, n, i // {FAN}
)"""


def _frame_sql(text: str = "text") -> str:
    values = [f"{c}::VARCHAR" if c != "text" else text for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


#: crc32 of a short ASCII string, bit by bit
_CRC_SQL = (
    "list_reduce([4294967295::BIGINT] || list_transform(range(1, 1 + length(t)::BIGINT), lambda p: ord(substr(t, p, 1))::BIGINT),"
    " lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN (x % 2) = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"
)

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {_frame_sql()} AS h, doc_id::VARCHAR AS t,
    {_frame_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    CASE WHEN xor({_CRC_SQL}, 4294967295) % 5 = 0 THEN lowered ELSE h END AS probe FROM d
), {_tree_sql("nodes", "l")}, sub AS (
  SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM nodes WHERE n = 1
), {_tree_sql("top", "sub")}, steps AS (
  SELECT l.g, l.i AS leaf_i, nodes.level, nodes.i // {FAN} AS run,
    string_agg(nodes.h, '' ORDER BY nodes.i) FILTER (nodes.i < l.i // ({FAN}^nodes.level)::BIGINT) AS lefts,
    string_agg(nodes.h, '' ORDER BY nodes.i) FILTER (nodes.i > l.i // ({FAN}^nodes.level)::BIGINT) AS rights
  FROM l JOIN nodes ON nodes.g = l.g AND nodes.n > 1 AND nodes.i // {FAN} = l.i // ({FAN}^(nodes.level + 1))::BIGINT
  GROUP BY ALL
  UNION ALL
  SELECT s.name, NULL, 1000 + top.level, NULL,
    string_agg(top.h, '' ORDER BY top.i) FILTER (top.i < s.i // ({FAN}^top.level)::BIGINT),
    string_agg(top.h, '' ORDER BY top.i) FILTER (top.i > s.i // ({FAN}^top.level)::BIGINT)
  FROM sub s JOIN top ON top.n > 1 AND top.i // {FAN} = s.i // ({FAN}^(top.level + 1))::BIGINT
  GROUP BY s.name, top.level, s.i
), paths AS (
  SELECT l.doc_id, l.g, l.i, l.h, l.probe,
    list({{'x': coalesce(lefts, ''), 'y': coalesce(rights, '')}} ORDER BY level) FILTER (level IS NOT NULL) AS s
  FROM l LEFT JOIN steps ON steps.g = l.g AND (steps.leaf_i = l.i OR steps.leaf_i IS NULL)
  GROUP BY ALL
), folded AS (
  SELECT doc_id, g, i, h, s, 0 AS done, probe AS f FROM paths
  UNION ALL
  SELECT doc_id, g, i, h, s, done + 1, sha256(s[done + 1].x || f || s[done + 1].y) FROM folded WHERE done < len(s)
)
SELECT doc_id, folded.h AS leaf, sub.h AS subroot, top.h AS root,
  sha256(coalesce(array_to_string(list_transform(s, lambda z: z.x || z.y), ''), '')) AS proof_sha256,
  f AS folded_root, f = top.h AS verified
FROM folded JOIN sub ON sub.name = folded.g JOIN top ON top.n = 1
WHERE done = coalesce(len(s), 0)
"""
