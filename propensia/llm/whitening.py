"""Whitening of embeddings by a bidiagonal qd solver.

The principal directions of centred rows are the right singular vectors of the
row matrix, which is never multiplied with itself: forming the covariance would
square its condition number.

1. Blockwise QR: a task reduces its centred rows, a block at a time, to one
   upper triangular factor; the factors of ``MERGE`` tasks at a time are
   stacked and reduced again, in as many Spark stages as it takes, until one
   d x d factor R with ``R'R = X'X`` is left.
2. Householder reflections from both sides make R bidiagonal, ``R = U B W'``.
3. dqds, the differential quotient-difference transform with shifts, finds
   the squared singular values of B. It only adds, multiplies and divides
   positive numbers, so every one is accurate relative to itself, the smallest
   as well as the largest.
4. Twisted factorisations of ``B'B - s`` (a stationary transform from the top,
   a progressive one from the bottom, joined where the twist is smallest) give
   each singular vector in O(d) steps without iteration; vectors of values that
   agree to many digits are made orthogonal among themselves. ``W`` leads back
   to the directions.

Steps 2 to 4 work on one d x d matrix (d: length of a vector, at most
``MOST_DIMS``), whatever the number of rows. Entries are first made integers,
``floor(grid * c) + offset``, so sums and deviations are exact and rows are
centred before anything is multiplied: ``(n x - S) / n``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import materialize, ship

GRID, OFFSET = 64.0, 1_000_000
BLOCK_ROWS, MERGE = 4096, 32
MOST_DIMS = 4096
EPS = np.finfo(np.float64).eps
TINY = 1e-290
#: Values closer than this (relative) get vectors that are made orthogonal together.
CLOSE = 1e-4


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal a, superdiagonal b, W) of a square matrix with ``r'r = W B'B W'``."""
    r = np.array(r, dtype=np.float64)
    d = len(r)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        """v, beta with (I - beta v v') x = (-sign(x0) |x|, 0, ...)."""
        top = float(np.abs(x).max(initial=0.0))
        if top == 0.0:
            return x, 0.0
        v = x / top
        v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, beta = reflector(r[k:, k])
        if beta:
            r[k:, k:] -= np.outer(beta * v, v @ r[k:, k:])
        if k < d - 2:
            v, beta = reflector(r[k, k + 1 :])
            if beta:
                r[k:, k + 1 :] -= np.outer(r[k:, k + 1 :] @ v, beta * v)
                w[:, k + 1 :] -= np.outer(w[:, k + 1 :] @ v, beta * v)
    return np.diag(r).copy(), np.diag(r, 1).copy(), w


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix without zeros, falling.

    A shift that would make a pivot negative is refused and a smaller one
    tried, at last none; values split off at the bottom when the last
    superdiagonal is negligible against what has been shifted away and its
    own pivot.
    """
    found: list[float] = []
    todo = [([float(x) * float(x) for x in a], [float(x) * float(x) for x in b], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        hold = 0  # rounds without a split
        while q:
            m = len(q)
            if m == 1:
                found.append(q[0] + moved)
                break
            if e[-1] <= (EPS * EPS) * q[-1] or e[-1] <= EPS * EPS * moved:
                found.append(q.pop() + moved)
                e.pop()
                hold = 0
                continue
            cut = next((k for k in range(m - 2, -1, -1) if e[k] <= EPS * EPS * min(q[k], q[k + 1]) or e[k] <= EPS * EPS * moved), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e, hold = q[cut + 1 :], e[cut + 1 :], 0
                continue
            if q[0] < q[-1]:  # large values first: small ones then come out at the bottom
                q, e = q[::-1], e[::-1]  # the squares of the transposed matrix, read from its end
            shift = _shift(q, e) if hold % 7 != 6 else 0.0
            step = None
            while step is None:
                step = _transform(q, e, shift)
                if step is None:
                    shift = shift / 4 if shift > 1e-3 * min(q) else 0.0
            q, e = step
            moved, hold = moved + shift, hold + 1
    return np.sort(np.array(found))[::-1]


def _shift(q: list[float], e: list[float]) -> float:
    """A little less than the smaller eigenvalue of the last 2 x 2 part of B B'."""
    x, y, z = q[-2] + e[-1], q[-1], q[-1] * e[-1]
    half, mean = (x - y) / 2, (x + y) / 2
    low = (x * y - z) / (mean + math.hypot(half, math.sqrt(z)))
    return max(0.0, min(low, min(q))) * (1 - 1e-3)


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step; None if the shift exceeds the smallest value."""
    qs, es, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        top = max(d + e[k], TINY)
        t = q[k + 1] / top
        qs.append(top)
        es.append(e[k] * t)
        d = d * t - shift
    if d < 0:
        return None
    qs.append(max(d, TINY))
    return qs, es


def twisted(a: np.ndarray, b: np.ndarray, value: float, skip: int = 0) -> tuple[np.ndarray, float]:
    """(unit vector z with ``B'B z`` close to ``value z``, the value corrected by the twist).

    ``skip`` > 0 twists at the next best place, for values in a cluster.
    """
    n = len(a)
    pivots = a * a
    ratio = b / a[:-1]
    low, lows = np.zeros(n), np.zeros(max(n - 1, 0))
    s = -value
    for i in range(n):
        low[i] = s
        if i < n - 1:
            top = s + pivots[i]
            top = top if abs(top) > TINY else TINY
            lows[i] = pivots[i] * ratio[i] / top
            s = lows[i] * ratio[i] * s - value
    high, highs = np.zeros(n), np.zeros(max(n - 1, 0))
    p = pivots[n - 1] - value
    high[n - 1] = p
    for i in range(n - 2, -1, -1):
        top = pivots[i] * ratio[i] * ratio[i] + p
        top = top if abs(top) > TINY else TINY
        t = pivots[i] / top
        highs[i] = ratio[i] * t
        p = p * t - value
        high[i] = p
    twist = low + high + value
    order = np.argsort(np.abs(np.where(np.isfinite(twist), twist, np.inf)), kind="stable")
    at = int(order[min(skip, n - 1)])
    z = np.zeros(n)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lows[i] * z[i + 1]
    for i in range(at, n - 1):
        z[i + 1] = -highs[i] * z[i]
    norm = float(np.linalg.norm(z))
    return z / norm, value + float(twist[at]) / (norm * norm)


def singular_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; right singular vectors as columns) of a square matrix.

    Values that rounding alone could have made (below ``d * eps`` of the
    largest singular value) come out as 0 with no vector: their columns are
    left out, so there may be fewer columns than values.
    """
    d = len(r)
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(d), np.zeros((d, 0))
    a, b, w = bidiagonalise(r / scale)
    # An exact zero on the diagonal is replaced by the least positive pivot: the change is below rounding.
    a = np.where(np.abs(a) < 1e-140, 1e-140, a)
    b = np.where(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])) / 4, 0.0, b)
    cuts = [0, *(np.flatnonzero(b == 0.0) + 1), d]
    values, vectors = [], []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        own_a, own_b = a[lo:hi], b[lo : hi - 1]
        found = dqds(own_a, own_b)
        block = np.zeros((d, hi - lo))
        group = 0
        for j, value in enumerate(found):
            near = j > 0 and found[j - 1] - value <= CLOSE * found[j - 1]
            group = group + 1 if near else 0
            for skip in range(hi - lo):  # of equal values the next best twist gives another vector
                z, better = twisted(own_a, own_b, float(value), skip=skip)
                for k in [*range(j - group, j)] * 2:  # twice is enough
                    z = z - (block[lo:hi, k] @ z) * block[lo:hi, k]
                if (length := float(np.linalg.norm(z))) > 0.1:
                    break
            if group == 0 and abs(better - value) <= 64 * EPS * value:
                value = better
            block[lo:hi, j] = z / length
            values.append(value)
        vectors.append(block)
    values, z = np.array(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    values, z = values[order], z[:, order]
    real = np.sqrt(values) > d * EPS * math.sqrt(values[0])
    return np.where(real, values, 0.0) * scale * scale, (w @ z)[:, real]


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: number of rows, exact sums of the integers, covariance's eigenvalues and directions."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray  # d x k, unit columns
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def integers(vector: str = "embedding", grid: float = GRID, offset: int = OFFSET):
    """The vector as integers; null if it is null or empty or an entry is null, non-finite or beyond 62 bits."""
    entries = F.col(vector).cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * F.lit(grid)) > F.lit(2.0**61)))
    whole = F.transform(entries, lambda c: F.floor(c * F.lit(grid)).cast("long") + F.lit(offset).cast("long"))
    return F.when(F.col(vector).isNotNull() & (F.size(entries) > 0) & ~F.coalesce(bad, F.lit(True)), whole)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, subtracted as integers and divided once."""
    return _spread(x, n, sums).astype(np.float64) / n


def _spread(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S; Python integers where 64 bits might not hold them."""
    if n * float(np.abs(x).max(initial=0)) < 2.0**62:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums of (n x - S)^2; None beyond 64 bits."""
    spread = _spread(x, n, sums)
    if spread.dtype != object and float(np.abs(spread.astype(np.float64)).max(initial=0.0)) ** 2 * x.shape[1] < 2.0**62:
        return (spread * spread).sum(axis=1).tolist()
    totals = [sum(int(v) * int(v) for v in row) for row in spread]
    return [t if t < 1 << 63 else None for t in totals]


def fit(rows: DataFrame, dims: int, n: int, sums: list[int]) -> Whitening:
    """Directions of the rows' integer vectors ``x`` (all of length ``dims``)."""
    ship(rows.sparkSession)
    total = np.array(sums, dtype=object)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor = np.zeros((0, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for at in range(0, len(x), BLOCK_ROWS):
                block = centred(x[at : at + BLOCK_ROWS], n, total)
                factor = np.linalg.qr(np.vstack([factor, block]), mode="r")
        yield _factors([(TaskContext.get().partitionId(), factor)] if len(factor) else [])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, factor in _merged(batches, dims):
            yield _factors([(group, factor)])

    factors = materialize(rows.select("x").mapInArrow(reduce_rows, "part long, data binary"), "factors")
    while factors.count() > MERGE:  # a factor a task; each round leaves one of MERGE
        dealt = factors.withColumn("part", F.floor(F.col("part") / MERGE).cast("long")).repartition("part").sortWithinPartitions("part")
        factors = materialize(dealt.mapInArrow(merge, "part long, data binary"), "factors")
    last = factors.orderBy("part").collect()  # at most MERGE factors of d x d
    r = np.zeros((0, dims))
    for f in last:
        r = np.linalg.qr(np.vstack([r, np.frombuffer(f["data"]).reshape(-1, dims)]), mode="r")
    square = np.zeros((dims, dims))
    square[: len(r)] = r
    squares, directions = singular_vectors(square)
    # The sign: a direction's largest entry is positive.
    for k in range(directions.shape[1]):
        if directions[np.argmax(np.abs(directions[:, k])), k] < 0:
            directions[:, k] *= -1
    return Whitening(n, tuple(sums), squares[: directions.shape[1]] / n, directions, float(squares.sum()) / n)


def _factors(rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    data = [np.ascontiguousarray(f).tobytes() for _, f in rows]
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int64()), pa.array(data, pa.binary())], names=["part", "data"])


def _merged(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, factor) of the factors of each part, which come together."""
    now, factor = None, None
    for batch in batches:
        for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = np.frombuffer(data).reshape(-1, dims)
            if part != now:
                if factor is not None:
                    yield now, factor
                now, factor = part, more
            else:
                factor = np.linalg.qr(np.vstack([factor, more]), mode="r")
    if factor is not None:
        yield now, factor


def prepare(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", grid: float = GRID, offset: int = OFFSET) -> DataFrame:
    """(id, x) of the rows whose vector is whole; written."""
    rows = vectors.select(F.col(key).alias("id"), integers(vector, grid, offset).alias("x")).filter("x is not null")
    return materialize(rows, "vectors")


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = 32, grid: float = GRID, offset: int = OFFSET) -> DataFrame:
    """A row per vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are left
    out; if lengths differ, those of the most frequent length stay (of ties,
    the longer); so are those with entries that ``grid`` takes beyond 62 bits. Null, tied and repeated keys: each row stands for itself.
    Components without variance can't be whitened and are left out, so a
    single vector or only equal ones give no rows, and so does an empty table.
    ``deviation`` is null where it exceeds 64 bits. Other columns
    are not read.
    """
    rows = prepare(vectors, key=key, vector=vector, grid=grid, offset=offset)
    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, component int, n long, deviation long, whitened double, explained double"
    none = rows.sparkSession.createDataFrame([], ddl + ", identity_error double").withColumnRenamed("id", key)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return none
    dims, n = lengths["d"], lengths["n"]
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} entries: the solver holds a square of them, at most {MOST_DIMS}")
    rows = rows.filter(F.size("x") == dims)
    placed = rows.select(F.posexplode("x").alias("i", "c"))
    # Sums as decimals: exact for any number of rows.
    sums = [int(r["s"]) for r in placed.groupBy("i").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).orderBy("i").collect()]  # d rows
    model = fit(rows, dims, n, sums)
    k = min(components, model.directions.shape[1])
    if k == 0:
        return none
    total = np.array(sums, dtype=object)
    basis = model.directions[:, :k] / np.sqrt(model.values[:k])
    shares = (model.values[:k] / model.trace).tolist()

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            y = centred(_matrix(batch.column(0), dims), n, total) @ basis
            gram, mean = gram + y.T @ y, mean + y.sum(axis=0)
        i, j = np.triu_indices(k)
        places = np.concatenate([i * k + j, k * k + np.arange(k)])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(np.concatenate([gram[i, j], mean]))], names=["place", "value"])

    found = rows.select("x").mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()  # k (k + 3) / 2 rows
    gram, mean = np.zeros((k, k)), np.zeros(k)
    for r in found:
        if r["place"] >= k * k:
            mean[r["place"] - k * k] = r["value"] / n
        else:
            gram[divmod(r["place"], k)] = r["value"] / n
    i, j = np.triu_indices(k)
    error = float(np.abs((gram - np.outer(mean, mean) - np.eye(k))[i, j]).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            m = len(x)
            y = centred(x, n, total) @ basis
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, dtype=np.int64)),
                pa.array(_deviations(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(y.ravel()),
                pa.array(np.tile(shares, m)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained"])

    out = rows.mapInArrow(project, ddl).withColumn("identity_error", F.lit(error))
    return out.withColumnRenamed("id", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened to 32 components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
