"""ML2: boosted trees by second-order histograms, all calibration folds in one pass.

Features are cut into at most ``BINS`` ranges at quantiles of a sketch and rows
become a few bytes each, written once. A tree grows level by level; a level
needs, for each fold, node, feature and bin, the sums of gradients and second
derivatives of the weighted logistic loss, and from them the best split of every
node of every fold follows. Gradients are kept as multiples of 2**-24, so sums
are exact integers and trees don't depend on how rows are partitioned.

One job a level returns ``folds * nodes * features * bins`` sums, however many
rows there are: tasks add up theirs as arrays, Spark adds those up as a tree. Rows
lie in blocks of one fold, feature by feature, with their margins; a round's
margins are kept by Spark (on disk where memory ends) while its levels are built
and every ``KEPT_ROUNDS`` rounds as a checkpoint, so a level applies no finished
tree and a lost executor costs a few rounds of its own blocks. Below
``LOCAL_ROWS`` rows (some MB of bins) the 800 levels of a model would be all job
overhead: there a task a fold runs the same loop over the same sums. Both ways
give the same trees to the last bit.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.session import checkpoint_dir, drop_copy, materialize, ship

BINS = 64
SCALE = float(1 << 24)
KEPT_ROUNDS = 10
LOCAL_ROWS = 1_000_000
BLOCK, TASK_ROWS = 1 << 16, 1 << 18  # rows of a block (its arrays fit a core's cache) and of a task
LAMBDA, LEAST_CHILD = 1.0, 1.0
#: ``bin`` of a node that isn't split: all rows go left.
ALL_LEFT = 255


@dataclass
class Tree:
    """Nodes level by level: feature (-1: not split), last bin that goes left; values of the leaves."""

    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray

    def node(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row at a level, counted from the left; ``bins`` by feature."""
        at = np.zeros(bins.shape[1], dtype=np.uint8 if levels <= 8 else np.uint32)
        feature, last = self.feature.tolist(), self.bin.tolist()  # plain numbers: comparisons stay in bytes
        for level in range(levels):
            right = np.zeros(len(at), dtype=bool)
            for n in range(1 << level):
                i = (1 << level) - 1 + n
                if feature[i] >= 0:
                    right |= (at == n) & (bins[feature[i]] > last[i])
            at = at << 1 | right
        return at

    def value(self, bins: np.ndarray) -> np.ndarray:
        return self.leaf[self.node(bins, len(self.leaf).bit_length() - 1)]


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives in steps of 1 / SCALE (whole numbers, as doubles)."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(weight * (p - label) * SCALE), np.rint(weight * p * (1.0 - p) * SCALE)


def histograms(bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int) -> np.ndarray:
    """Sums of g and h as array (2, nodes, features, BINS)."""
    out = np.zeros((2, nodes, len(bins), BINS), dtype=np.int64)
    first = node.astype(np.intp) * BINS
    for f, column in enumerate(bins):
        cell = first + column
        for i, values in enumerate((g, h)):
            out[i, :, f] = np.bincount(cell, weights=values, minlength=nodes * BINS).reshape(nodes, BINS)
    return out


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, sums of both sides (2, nodes, 2)) of each node's best split; of equal ones the first."""
    left = np.cumsum(sums, axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    (gl, hl), (gr, hr), (g, h) = left / SCALE, right / SCALE, total / SCALE
    gain = gl**2 / (hl + LAMBDA) + gr**2 / (hr + LAMBDA) - g**2 / (h + LAMBDA)
    gain = np.where((hl >= LEAST_CHILD) & (hr >= LEAST_CHILD), gain, 0.0).reshape(len(g), -1)
    best = np.argmax(gain, axis=1)
    found = gain[np.arange(len(best)), best] > 1e-9
    feature, cut = np.where(found, best // BINS, -1), np.where(found, best % BINS, ALL_LEFT)
    n, f, b = np.arange(len(best)), np.maximum(feature, 0), np.where(found, cut, BINS - 1)
    return feature, cut, np.stack([left[:, n, f, b], right[:, n, f, b]], axis=2)


def grow(level_sums: Callable[[int, list[Tree]], list[np.ndarray]], folds: int, depth: int, step: float) -> list[Tree]:
    """One tree a fold. ``level_sums(level, trees)`` gives each fold's histograms below its unfinished tree."""
    splits = (1 << depth) - 1
    trees = [Tree(np.full(splits, -1), np.full(splits, ALL_LEFT), np.zeros(1 << depth)) for _ in range(folds)]
    for level in range(depth):
        for tree, sums in zip(trees, level_sums(level, trees), strict=True):
            at = slice((1 << level) - 1, (1 << (level + 1)) - 1)
            tree.feature[at], tree.bin[at], sides = best_splits(sums)
            if level == depth - 1:
                g, h = sides.reshape(2, -1) / SCALE
                tree.leaf[:] = -step * g / (h + LAMBDA)
    return trees


def quantile_edges(frame: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Up to ``bins - 1`` distinct cuts of each feature, ascending (one aggregate over all of them)."""
    shares = [i / bins for i in range(1, bins)]
    found = frame.agg(*(F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"q{i}") for i, f in enumerate(features))).first()
    return [sorted(set(q or [])) for q in found]


def cut(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """The bin of each value: the number of cuts below it (NaN: the last)."""
    return np.column_stack([np.searchsorted(np.array(e), values[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)


def binned(frame: DataFrame, features: list[str], edges: list[list[float]], label: str, weight: float) -> DataFrame:
    """(fold, label, bins) of every row, written."""
    ship(frame.sparkSession)
    rows = frame.select(F.col("fold").cast("int").alias("fold"), F.col(label).cast("int").alias("label"), *(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.column_stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(edges))])
            data = [row.tobytes() for row in cut(values, edges)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["fold", "label", "bins"])

    return materialize(rows.mapInArrow(run, "fold int, label int, bins binary").hint("rebalance"), "binned")


def _rows(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = batch.column("bins").to_pylist()
    bins = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(len(data), -1)
    return batch.column("fold").to_numpy(), batch.column("label").to_numpy().astype(float), bins


def _blocks(fold: np.ndarray, label: np.ndarray, bins: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(fold, labels, bins by feature) of at most ``BLOCK`` rows of one fold."""
    for k in np.unique(fold).tolist():
        own = np.flatnonzero(fold == k)
        for at in range(0, len(own), BLOCK):
            rows = own[at : at + BLOCK]
            yield k, label[rows], np.ascontiguousarray(bins[rows].T)


def _block_sums(tree: Tree, level: int, label: np.ndarray, bins: np.ndarray, margin: np.ndarray, weight: float) -> np.ndarray:
    """A block's histograms below an unfinished tree."""
    g, h = gradients(margin, label, np.where(label == 1, weight, 1.0))
    return histograms(bins, tree.node(bins, level), g, h, 1 << level)


def boost(data: DataFrame, folds: int, weight: float, rounds: int, depth: int, step: float, local_rows: int = LOCAL_ROWS) -> list[list[Tree]]:
    """Trees of each fold's model, which learns from the rows of the other folds. ``weight``: of positive rows."""
    rows = data.count()
    if rows <= local_rows:
        return _boost_in_tasks(data, folds, weight, rounds, depth, step)
    return _boost_by_levels(data, rows, folds, weight, rounds, depth, step)


def _boost_in_tasks(data: DataFrame, folds: int, weight: float, rounds: int, depth: int, step: float) -> list[list[Tree]]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        fold, label, bins = _rows(table)
        width = bins.shape[1]
        blocks = [(y, x) for own, y, x in _blocks(fold, label, bins) if own != k]
        margins, trees = [np.zeros(len(y)) for y, _ in blocks], []

        def level_sums(level: int, now: list[Tree]) -> list[np.ndarray]:
            total = np.zeros((2, 1 << level, width, BINS), dtype=np.int64)
            for (y, x), margin in zip(blocks, margins, strict=True):
                total += _block_sums(now[0], level, y, x, margin, weight)
            return [total.astype(float)]

        for _ in range(rounds):
            (tree,) = grow(level_sums, 1, depth, step)
            margins = [margin + tree.value(x) for (_, x), margin in zip(blocks, margins, strict=True)]
            trees.append(tree)
        return pa.table({"k": pa.array([k], pa.int32()), "trees": pa.array([json.dumps([_plain(t) for t in trees])])})

    copies = data.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    found = {r["k"]: json.loads(r["trees"]) for r in copies.groupBy("k").applyInArrow(run, "k int, trees string").collect()}  # a row a fold
    return [[_tree(t) for t in found[k]] for k in range(folds)]


def _boost_by_levels(data: DataFrame, rows: int, folds: int, weight: float, rounds: int, depth: int, step: float) -> list[list[Tree]]:
    spark = data.sparkSession
    checkpoint_dir(spark)
    width = len(data.first()["bins"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            for k, label, bins in _blocks(*(np.concatenate(c) for c in zip(*held, strict=True))):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([label.astype(np.uint8).tobytes()], pa.binary()), pa.array([bins.tobytes()], pa.binary())], names=["fold", "labels", "bins"])

        for batch in batches:
            held.append(_rows(batch))
            size += batch.num_rows
            if size >= folds * BLOCK:
                yield from close()
                held, size = [], 0
        if size:
            yield from close()

    def started(row) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
        label = np.frombuffer(row["labels"], np.uint8)
        return label, np.frombuffer(row["bins"], np.uint8).reshape(width, -1), [None if k == row["fold"] else np.zeros(len(label)) for k in range(folds)]

    def sums_of(now: list[Tree], level: int):
        def run(blocks: Iterator) -> Iterator[np.ndarray]:
            total = np.zeros((folds, 2, 1 << level, width, BINS), dtype=np.int64)
            for label, bins, margins in blocks:
                for k, margin in enumerate(margins):
                    if margin is not None:
                        total[k] += _block_sums(now[k], level, label, bins, margin, weight)
            yield total

        return run

    def advanced(last: list[Tree]):
        def run(block: tuple) -> tuple:
            label, bins, margins = block
            # tree by tree, as the rounds are: sums of doubles depend on their order
            return label, bins, [None if m is None else m + tree.value(bins) for m, tree in zip(margins, last, strict=True)]

        return run

    parts = max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    blocks = data.repartition(parts).mapInArrow(packed, "fold int, labels binary, bins binary")
    state = materialize(blocks, "blocks").rdd.map(started).persist(StorageLevel.MEMORY_AND_DISK)
    done: list[list[Tree]] = [[] for _ in range(folds)]
    before, written = None, None  # the state that this one is made of; the last checkpoint
    for n in range(rounds):
        if n:
            before, state = state, state.map(advanced([trees[-1] for trees in done])).persist(StorageLevel.MEMORY_AND_DISK)
            if n % KEPT_ROUNDS == 0:
                state.checkpoint()

        def level_sums(level: int, now: list[Tree], state=state, before=before) -> list[np.ndarray]:
            total = state.mapPartitions(sums_of(now, level)).treeReduce(np.add)
            if level == 0 and before is not None:
                before.unpersist()
            return list(total.astype(float))

        for trees, tree in zip(done, grow(level_sums, folds, depth, step), strict=True):
            trees.append(tree)
        if n and n % KEPT_ROUNDS == 0:
            if written is not None:
                drop_copy(spark, written)
            written = state.getCheckpointFile()
    state.unpersist()
    if written is not None:
        drop_copy(spark, written)
    return done


def _plain(tree: Tree) -> dict:
    return {"feature": tree.feature.tolist(), "bin": tree.bin.tolist(), "leaf": tree.leaf.tolist()}


def _tree(plain: dict) -> Tree:
    return Tree(np.array(plain["feature"]), np.array(plain["bin"]), np.array(plain["leaf"]))


def raw_margin(trees: list[Tree], bins: np.ndarray) -> np.ndarray:
    """Margins of rows of bins."""
    margin, columns = np.zeros(len(bins)), np.ascontiguousarray(bins.T)
    for tree in trees:
        margin = margin + tree.value(columns)
    return margin


# ------------------------------------------------------- ML3, calibration --
def pool(points: Iterator[tuple[float, float, float, float]]) -> list[list[float]]:
    """Pool adjacent violators: (low, high, sum, weight) ascending -> blocks with rising means."""
    blocks: list[list[float]] = []
    for low, high, total, weight in points:
        blocks.append([low, high, total, weight])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, total, weight = blocks.pop()
            blocks[-1][1:] = [high, blocks[-1][2] + total, blocks[-1][3] + weight]
    return blocks


def isotonic(points: DataFrame, partitions: int | None = None, merge: int = 16) -> DataFrame:
    """(fold, low, high, total, weight): the blocks of each fold's isotonic regression, ascending.

    ``points``: fold, p, total (sum of labels) and weight, one row per fold and
    p. Ranges of (fold, p) are pooled on their own, then neighbouring ranges
    together, ``merge`` at a time, until one is left: pooling may go in any
    order, and every round passes on blocks instead of points. Sums of labels
    are whole numbers, so the result doesn't depend on the ranges.
    """
    ship(points.sparkSession)
    ddl = "fold int, low double, high double, total double, weight double, part long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True))
        for fold, own in groupby(rows, key=lambda r: r[0]):
            blocks = pool(r[1:] for r in own)
            columns = [pa.array(list(c), pa.float64()) for c in zip(*blocks, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([fold] * len(blocks), pa.int32()), *columns, pa.array([part] * len(blocks), pa.int64())], names=["fold", "low", "high", "total", "weight", "part"])

    rows = points.select(F.col("fold").cast("int").alias("fold"), F.col("p").alias("low"), F.col("p").alias("high"), F.col("total").cast("double").alias("total"), F.col("weight").cast("double").alias("weight"))
    dealt = rows.repartitionByRange(partitions, "fold", "low") if partitions else rows.repartitionByRange("fold", "low")
    ranged = dealt.sortWithinPartitions("fold", "low")
    blocks = materialize(ranged.mapInArrow(run, ddl), "blocks")
    while (blocks.agg(F.max("part")).first()[0] or 0) > 0:
        together = blocks.withColumn("part", F.floor(F.col("part") / merge).cast("long")).repartition("part")
        pooled = together.sortWithinPartitions("part", "fold", "low").mapInArrow(_by_part(merge), ddl)
        blocks = materialize(pooled, "blocks")
    return blocks.drop("part")


def _by_part(merge: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (part, fold), own in groupby(rows, key=lambda r: (r[5], r[0])):
            blocks = pool(r[1:5] for r in own)
            columns = [pa.array(list(c), pa.float64()) for c in zip(*blocks, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([fold] * len(blocks), pa.int32()), *columns, pa.array([part] * len(blocks), pa.int64())], names=["fold", "low", "high", "total", "weight", "part"])

    return run


# ------------------------------------------------------------- the model --
@dataclass
class PropensityModel:
    """Fold models and their calibrations; the score is the mean of the calibrated probabilities."""

    features: list[str]
    edges: list[list[float]]
    trees: list[list[Tree]]
    curves: list[tuple[list[float], list[float]]]  # (p, calibrated p) of each fold, ascending; linear in between

    @property
    def feature_columns(self) -> list[str]:
        return list(self.features)

    def fold_scores(self, values: np.ndarray, calibrated: bool = True) -> np.ndarray:
        """Probabilities of each row by each fold's model."""
        bins = cut(values, self.edges)
        columns = []
        for trees, (x, y) in zip(self.trees, self.curves or [([], [])] * len(self.trees), strict=True):
            p = 1.0 / (1.0 + np.exp(-raw_margin(trees, bins)))
            columns.append(np.interp(p, x, y) if calibrated else p)
        return np.column_stack(columns)

    def score(self, df: DataFrame, out: str, which: str = "mean") -> DataFrame:
        """``df`` with column ``out``: the mean score, or an array of the folds' (``calibrated`` or ``raw``)."""
        ship(df.sparkSession)
        kind = "double" if which == "mean" else "array<double>"

        @F.pandas_udf(kind)
        def scored(*columns: pd.Series) -> pd.Series:
            values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            found = self.fold_scores(values, which != "raw")
            return pd.Series(found.mean(axis=1) if which == "mean" else list(found))

        return df.withColumn(out, scored(*(F.col(f).cast("double") for f in self.features)))

    def transform(self, df: DataFrame) -> DataFrame:
        """ML3: rows with ``propensity_score``. A missing feature counts as larger than all others."""
        return self.score(df, "propensity_score")

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "edges": self.edges, "trees": [[_plain(t) for t in trees] for trees in self.trees], "curves": self.curves})

    @staticmethod
    def from_json(text: str) -> "PropensityModel":
        plain = json.loads(text)
        curves = [(list(x), list(y)) for x, y in plain["curves"]]
        return PropensityModel(plain["features"], plain["edges"], [[_tree(t) for t in trees] for trees in plain["trees"]], curves)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PropensityModel":
        return PropensityModel.from_json(spark.read.parquet(path).first()["model"])


def fit(frame: DataFrame, features: list[str], label: str, weight: float, *, folds: int, rounds: int, depth: int, step: float, local_rows: int = LOCAL_ROWS) -> PropensityModel:
    """ML2 + ML3 on ``frame``, whose column ``fold`` deals its rows to 0 .. folds - 1."""
    edges = quantile_edges(frame, features)
    data = binned(frame, features, edges, label, weight)
    trees = boost(data, folds, weight, rounds, depth, step, local_rows)
    held = _held_out(data, trees)
    points = held.groupBy("fold", "p").agg(F.sum("label").alias("total"), F.count(F.lit(1)).alias("weight"))
    curves: list[tuple[list[float], list[float]]] = []
    blocks = isotonic(points).orderBy("fold", "low").collect()  # the model's own steps
    for k in range(folds):
        x, y = [], []
        for b in (b for b in blocks if b["fold"] == k):
            ends = [b["low"]] if b["low"] == b["high"] else [b["low"], b["high"]]
            x += ends
            y += [b["total"] / b["weight"]] * len(ends)
        curves.append((x, y))
    return PropensityModel(list(features), edges, trees, curves)


def _held_out(data: DataFrame, trees: list[list[Tree]]) -> DataFrame:
    """(fold, p, label): every row's probability by the model that didn't see it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, label, bins = _rows(batch)
            p = np.zeros(len(fold))
            for k, own in enumerate(trees):
                p[fold == k] = 1.0 / (1.0 + np.exp(-raw_margin(own, bins[fold == k])))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), pa.array(p), batch.column("label")], names=["fold", "p", "label"])

    return data.mapInArrow(run, "fold int, p double, label int")
