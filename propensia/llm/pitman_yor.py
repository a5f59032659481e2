"""Hierarchical Pitman-Yor language model.

Three levels of restaurants, dishes are words. The context of a word is the whole
word before it: every word of the training texts has a restaurant of its own, and
so has the start of a text. Restaurants of words send their tables as customers to
one of their ending (last two bytes; every ending has its own, of the ``CONTEXTS``
that there can be), those to one common parent, whose base is uniform over the V
words of the training texts and one unknown. With c customers and t tables of word
w in restaurant k

    P(w | k) = (c - d t) / (a + C_k) + (a + d T_k) / (a + C_k) * P(w | restaurant above k)

A word never seen in training leaves it to its ending. Table counts are sampled by
Gibbs, all customers of a dish at once: its t is drawn from its distribution given
all other seatings,

    S_d(c, t) (a + d T') (a + d (T' + 1)) ... * S_d0(c0' + t, t0) / (a + C0') ...

(T', c0' and C0' without the dish; 0: the restaurant above), one restaurant of a
dish above after the other (beyond ``ALONE`` of them a share 1 / ``ALONE`` of those
before at once, each as if the rest of those stood still), level by level, then
the parent's t0. The generalised Stirling numbers S come from a table below
``STIRLING`` customers; beyond it ``S_d(c, t) = c! / (t! d^t) P(X1 + ... + Xt = c)``
with Sibuya variables X, whose chance is a contour integral of few nodes at any
c. ``SAMPLES`` samples after a burn-in give predictive probabilities that are
averaged for scoring. Discounts follow from the counts of ones and twos, as
usual: one for all restaurants of words, one for each of the others.

How it runs. Texts are tokenized once, in batches of some million tokens. A
batch keeps its texts as numbers into its own list of words and sends, for
each bucket of the hash of a word, one array of word hashes and counts by
word before: rows of arrays, not of words. A bucket's words from all batches meet
in one task, merged by sorting, and form the state that is sampled; a word
lies in one bucket with all its dishes of all levels, so a sweep
only needs the restaurants' totals. Those of endings, four numbers each that occurs,
are summed by Spark between sweeps; those of words are as many as the words, so
each bucket sends its part of them to the bucket of the word that names the
restaurant, which sums and answers (during one sweep they stand still). A dish
with one customer has one table: a restaurant's tables are its customers, the
occurrences of its word, less what its dishes of several customers save, and only
these are kept in the state and told. Finally each bucket
answers each batch with its words' counts and seatings and the probabilities at
the endings of just the pairs the batch asked for, and a batch scores its texts.
What moves grows with the
corpus; nothing but totals reaches the driver. A word held by any share of all
tokens is one entry a batch. States are written tables; lost tasks repeat.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import drop_copy, fill, hold_out, release, scratch_path, ship
from propensia.llm.warc import open_store

CONTEXTS = 1 + 256 + 65_536  # the start, endings of words of one byte, of two and more
BATCH_TOKENS = 1_500_000
BUCKET_BYTES = 16 << 20  # of text for each bucket
LEAST_BUCKETS = 16
STRENGTH = 1.0
BURN_IN, SAMPLES = 1, 3  # sweeps before and for samples
STIRLING = 256
ALONE = 16
NODES, COARSE, GRID = 20, 9, 33  # of a contour; table counts looked at to narrow the range and to draw
DRAWN = 1 << 20  # (dish, table count) held at once
AT_ONCE = 1 << 10  # contours
END = b""  # closes every text, and is what stands before its first word; no word is empty
SIZE = 4 * (CONTEXTS + 1) + 1  # of the sums of a ``Totals``


# --- arrays in a binary -----------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(v for a in arrays for v in (ord(a.dtype.char), a.size))], "<i8")
    return head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * n, 8)
    out, at = [], 8 * (1 + 2 * n)
    for char, size in head.reshape(-1, 2).tolist():
        kind = np.dtype(chr(char))
        out.append(np.frombuffer(data, kind, size, at))
        at += size * kind.itemsize
    return out


def smallest(a: np.ndarray) -> np.ndarray:
    """``a`` in the narrowest unsigned type that holds it."""
    top = int(a.max()) if a.size else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def press(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpress(data: bytes) -> list[np.ndarray]:
    return unpack(pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))


def planes(hashes: np.ndarray) -> np.ndarray:
    """Hashes, best in ascending order, as differences by bytes: the first of n differ little in their upper ones."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).ravel()


def from_planes(data: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


# --- batches of texts -------------------------------------------------------


def context_of(word: bytes) -> int:
    """The restaurant above that of this word: of its ending (of the end: the start of a text)."""
    if len(word) < 2:
        return 1 + word[0] if word else 0
    return 257 + 256 * word[-2] + word[-1]


class Batch:
    """Texts of one batch as numbers into its words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.texts: list[np.ndarray] = []
        self.keys: list[int | None] = []
        self.held: list[bool] = []
        self.size = 0

    def add(self, key: int | None, text: str, held: bool) -> None:
        found = text.encode().lower().split()
        found.append(END)
        known = self.known
        for w in set(found).difference(known):
            known[w] = len(self.words)
            self.words.append(w)
        self.texts.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
        self.keys.append(key)
        self.held.append(held)
        self.size += len(found)

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, arrays of its words) and, as bucket -1, the texts."""
        ids = np.concatenate(self.texts)
        lengths = np.array([len(t) for t in self.texts], np.int64)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        contexts = np.fromiter(map(context_of, self.words), np.int64, len(self.words))
        order = np.lexsort((hashes, bucket_of(hashes, buckets)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[ids]
        pair, inverse, _ = pairs_of(place, int(rank[self.known[END]]), len(order), lengths)
        trains = np.repeat(~np.array(self.held, bool), lengths)
        counts = np.bincount(inverse[trains], minlength=len(pair))
        word, before = pair // len(order), pair % len(order)
        per_word = np.bincount(word, minlength=len(order))
        hashes, endings = hashes[order], contexts[order]
        cuts = np.searchsorted(bucket_of(hashes, buckets), np.arange(buckets + 1).astype(np.uint64))
        pair_cuts = np.append(0, np.cumsum(per_word))[cuts]
        for b in range(buckets):
            w, p = slice(cuts[b], cuts[b + 1]), slice(pair_cuts[b], pair_cuts[b + 1])
            if cuts[b] < cuts[b + 1]:
                names, name = np.unique(before[p], return_inverse=True)
                yield b, press(pack(planes(hashes[w]), smallest(per_word[w]), smallest(name), smallest(counts[p]), planes(hashes[names]), smallest(endings[names])))
        # Texts: numbers by falling frequency, in planes of 16 and 16 bits, which compress well.
        often = np.argsort(-np.bincount(place, minlength=len(order)), kind="stable")
        number = np.empty(len(order), np.int64)
        number[often] = np.arange(len(order))
        numbers = number[place]
        by_number = smallest(endings[often])
        keys = np.array([0 if k is None else k for k in self.keys], np.int64)
        flags = np.array([(k is None) + 2 * h for k, h in zip(self.keys, self.held)], np.uint8)
        start = np.array([rank[self.known[END]]], np.uint32)
        yield -1, press(pack(keys, flags, lengths, start, (numbers & 0xFFFF).astype(np.uint16), smallest(numbers >> 16), often.astype(np.uint32), by_number))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(16)) % np.uint64(buckets)


def pairs_of(place: np.ndarray, start: int, words: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes ``words`` * word place + place of the word before, each token's code, starts of texts."""
    starts = np.cumsum(lengths) - lengths
    before = np.empty_like(place)
    before[1:] = place[:-1]
    before[starts] = start
    pair, inverse = np.unique(place * words + before, return_inverse=True)
    return pair, inverse, starts


def tokenized(docs: DataFrame, *, key: str, text: str, modulus: int, fold: int, buckets: int) -> DataFrame:
    """(batch, bucket, data) of all batches; bucket -1 holds the texts."""
    held = hold_out(key, modulus) == fold
    rows = docs.select(F.col(key).cast("long").alias("k"), fill(text).alias("t"), held.alias("h"), F.spark_partition_id().alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_batch, part, number = Batch(), 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            name = (part << 32) | number
            for b, data in open_batch.rows(buckets):
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([b], pa.int32()), pa.array([data], pa.binary())], names=["batch", "bucket", "data"])

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column(3)[i].as_py()
                open_batch.add(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
                if open_batch.size >= BATCH_TOKENS:
                    yield from close()
                    open_batch, number = Batch(), number + 1
        if open_batch.size:
            yield from close()

    return rows.mapInArrow(run, "batch long, bucket int, data binary")


# --- restaurants of one bucket ----------------------------------------------


@functools.lru_cache(maxsize=256)
def stirling(discount: float) -> np.ndarray:
    """[c, t] -> log S(c, t), c < STIRLING; S(c, t) = S(c - 1, t - 1) + (c - 1 - d t) S(c - 1, t)."""
    logs = np.full((STIRLING, STIRLING + 1), -np.inf)
    logs[0, 0] = 0.0
    t = np.arange(1, STIRLING + 1)
    for c in range(1, STIRLING):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.log(np.maximum(c - 1 - discount * t, 0)) + logs[c - 1, 1:]
        logs[c, 1:] = np.logaddexp(logs[c - 1, :-1], stay)
    return logs


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers."""
    y = x + 8.0
    rise = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    v = 1.0 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - v * (1 / 360 - v * (1 / 1260 - v / 1680))) / y - np.log(rise)


def log_stirling(c: np.ndarray, t: np.ndarray, d: np.ndarray) -> np.ndarray:
    """log S_d(c, t) for any 1 <= t <= c.

    The chance that t Sibuya variables (generating function 1 - (1 - z)^d) sum
    to c is an integral of exp(c s) (1 - (1 - exp(-s))^d)^t over s; it is taken
    along a parabola through the saddle point, or through 6 / c if that lies
    nearer to the branch point 0.
    """
    c, t, d = (np.asarray(a, float) for a in np.broadcast_arrays(c, t, d))
    flat, out = (c.ravel(), t.ravel(), d.ravel()), np.empty(c.size)
    for at in range(0, c.size, AT_ONCE):
        here = slice(at, at + AT_ONCE)
        out[here] = _contour(*(a[here] for a in flat))
    chance = np.where(t == c, c * np.log(d), out.reshape(c.shape))
    return lgamma(c + 1) - lgamma(t + 1) - t * np.log(d) + chance


def _contour(c: np.ndarray, t: np.ndarray, d: np.ndarray) -> np.ndarray:
    """log of the chance that t Sibuya variables sum to c."""
    low, high = np.log(6.0 / c), np.full(c.shape, np.log(30.0))
    known = np.log(t * d / c)
    for turn in range(14):  # halved, then Newton
        middle = (low + high) / 2 if turn < 10 else x
        s = np.exp(middle)
        q = -np.expm1(-s)
        log_q = np.log(q)
        power = np.exp(d * log_q)
        g = np.maximum(1 - power, 1e-300)
        f = known + d * log_q - log_q - np.log(g) - s
        low, high = np.where(f > 0, middle, low), np.where(f > 0, high, middle)
        x = (low + high) / 2
        if turn >= 9:
            slope = s * ((1 - q) * ((d - 1) / q + d * power / (q * g)) - 1)
            x = np.clip(middle - f / np.minimum(slope, -1e-9), low, high)
    mu = np.exp(x)
    q, z = -np.expm1(-mu), np.exp(-mu)
    g = -np.expm1(d * np.log(q))
    slope = d * q ** (d - 1) * z / g
    spread = t * (d * q ** (d - 2) * z * ((1 - d) * z + q) / g - slope * slope)
    with np.errstate(divide="ignore", invalid="ignore"):
        wide = np.where(spread > 0, 4.0 / (mu * np.sqrt(np.maximum(spread, 0))), np.inf)
    step = np.minimum(np.minimum(wide, np.sqrt(1 + 40 / (c * mu))), np.pi / (2 * mu)) / NODES
    top = t * np.log(g) + c * mu
    # s = mu (1 + iu)^2 = a + 2i half; 1 - exp(-s), then 1 - that ** d, by parts
    u = np.arange(1, NODES + 1)[:, None] * step
    a, half = mu * (1 - u * u), mu * u
    shrink, sine, cosine = np.exp(-a), np.sin(half), np.cos(half)
    re, im = 2 * shrink * sine * sine - np.expm1(-a), 2 * shrink * sine * cosine
    size, turned = np.exp(d / 2 * np.log(re * re + im * im)), d * np.arctan2(im, re)
    re, im = 1 - size * np.cos(turned), -size * np.sin(turned)
    phase = t * np.arctan2(im, re) + 2 * c * half
    total = 0.5 + (np.exp(t / 2 * np.log(re * re + im * im) + c * a - top) * (np.cos(phase) - u * np.sin(phase))).sum(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return top + np.log(np.maximum(2 * mu / np.pi * step * total, 0))


def seatings(c: np.ndarray, t: np.ndarray, d: np.ndarray, logs: np.ndarray, group: np.ndarray) -> np.ndarray:
    """log S_d(c, t) of integer arrays, from the tables ``logs`` of each group where they reach; t > c: -inf."""
    out = np.full(len(c), -np.inf)
    small = c < STIRLING
    fits = t <= c
    at = np.flatnonzero(small & fits)
    out[at] = logs[group[at], c[at], t[at]]
    at = np.flatnonzero(~small & fits)
    out[at] = log_stirling(c[at], t[at], d[at])
    return out


class ParentSeatings:
    """log S_d(rest + t, t0) of dishes with the same t0 for t = 1 .. c.

    Dishes of fewer than ``STIRLING`` customers that ask for many numbers beyond
    the table take them from the polynomial through ``SPOTS`` of them: c is
    below one doubling there, and t0 well below c, so it is off by less than 0.001.
    """

    SPOTS = 7

    def __init__(self, rest: np.ndarray, c: np.ndarray, t0: np.ndarray, d, logs: np.ndarray, group: np.ndarray | None = None):
        """``d`` and the table ``logs``: of all dishes, or of each and of its ``group``."""
        self.rest, self.t0, self.d = rest, t0, np.broadcast_to(np.asarray(d, float), c.shape)
        self.logs, self.group = (logs[None], np.zeros(len(c), np.int64)) if group is None else (logs, group)
        self.low, high = np.maximum(rest + 1, STIRLING), rest + c
        smooth = (c < STIRLING) & (high - self.low >= 2 * self.SPOTS) & (3 * t0 <= 2 * self.low)
        self.place = np.full(len(c), -1)
        at = np.flatnonzero(smooth)
        self.place[at] = np.arange(len(at))
        share = (1 - np.cos(np.pi * np.arange(self.SPOTS) / (self.SPOTS - 1))) / 2
        self.spots = np.rint(self.low[at, None] + (high - self.low)[at, None] * share).astype(np.int64)
        self.values = log_stirling(self.spots, t0[at, None], self.d[at, None])
        gaps = (self.spots[:, :, None] - self.spots[:, None, :]).astype(float)
        gaps[:, np.arange(self.SPOTS), np.arange(self.SPOTS)] = 1.0
        self.weights = 1.0 / gaps.prod(axis=2)

    def __call__(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        up = (self.rest[n] + t).astype(np.int64)
        drawn = (self.place[n] >= 0) & (up >= self.low[n])
        out = np.empty(len(up))
        at = np.flatnonzero(~drawn)
        out[at] = seatings(up[at], self.t0[n[at]], self.d[n[at]], self.logs, self.group[n[at]])
        at = np.flatnonzero(drawn)
        if at.size:
            dish = self.place[n[at]]
            over, under = np.zeros(len(at)), np.zeros(len(at))
            for i in range(self.SPOTS):
                gap = (up[at] - self.spots[dish, i]).astype(float)
                w = self.weights[dish, i] / np.where(gap == 0, 1e-9, gap)
                over, under = over + w * self.values[dish, i], under + w
            out[at] = over / under
        return out


def draw_small(c: np.ndarray, logs: np.ndarray, group: np.ndarray, extra, rng: np.random.Generator) -> np.ndarray:
    """t of each dish of c < STIRLING customers, with chances S(c, t) exp(extra(dish, t))."""
    out = np.empty(len(c), np.int64)
    bounds = np.append(0, np.cumsum(c))
    low = 0
    while low < len(c):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + DRAWN, "right")) - 1)
        n = c[low:high]
        dish = np.repeat(np.arange(low, high), n)
        first = bounds[low:high] - bounds[low]
        t = np.arange(len(dish)) - np.repeat(first, n) + 1
        p = logs[group[dish], c[dish], t] + extra(dish, t)
        p = np.exp(p - np.repeat(np.maximum.reduceat(p, first), n))
        mass = np.cumsum(p)
        before = mass[first] - p[first]
        aim = before + rng.random(len(n)) * (mass[first + n - 1] - before)
        out[low:high] = np.clip(np.searchsorted(mass, aim, "right") - first, 0, n - 1) + 1
        low = high
    return out


def draw_large(c: np.ndarray, d: np.ndarray, extra, rng: np.random.Generator, near: np.ndarray) -> np.ndarray:
    """The same for any c: the range that holds the mass is narrowed on a grid
    of table counts, first around ``near``; between two of the last grid's counts
    chances are geometric."""
    out = np.empty(len(c), np.int64)
    around = np.array([0, 0.25, 0.7, 0.9, 1, 1.1, 1.4, 4, np.inf])  # of near; COARSE of them
    for at in range(0, len(c), max(1, DRAWN // (8 * GRID))):
        dish = np.arange(at, min(len(c), at + max(1, DRAWN // (8 * GRID))))
        low, high = np.ones(len(dish)), c[dish].astype(float)
        rows = np.arange(len(dish))

        def chances(share: np.ndarray, live: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
            bottom, top = low[live, None], high[live, None]  # noqa: B023
            wide = top > 4 * bottom
            t = np.where(wide, bottom * (top / bottom) ** share, bottom + (top - bottom) * share)
            if turn == 0:
                t = np.minimum(near[dish[live], None] * around, top)  # noqa: B023
            t = np.rint(np.clip(t, bottom, top))
            t[:, -1] = top[:, 0]
            own = dish[live]  # noqa: B023
            p = log_stirling(c[own, None], t, d[own, None]) + extra(np.repeat(own, t.shape[1]), t.ravel()).reshape(t.shape)
            return t, np.where(np.isfinite(p), p, -np.inf)

        moving = rows
        for turn in range(24):
            t, p = chances(np.linspace(0, 1, COARSE), moving, turn)
            live = p > p.max(axis=1)[:, None] - 25
            first, end = live.argmax(axis=1), COARSE - 1 - live[:, ::-1].argmax(axis=1)
            here = np.arange(len(moving))
            bottom, top = t[here, np.maximum(first - 1, 0)], t[here, np.minimum(end + 1, COARSE - 1)]
            narrower = (top - bottom < 0.5 * (high[moving] - low[moving])) | (turn == 0) | (top > 4 * bottom) & ((top < high[moving]) | (bottom > low[moving]))
            low[moving], high[moving] = bottom, top
            moving = moving[narrower]
            if not len(moving):
                break
        t, p = chances(np.linspace(0, 1, GRID), rows, -1)
        # Cell i holds the counts t[i] <= x < t[i + 1], the last one only its own.
        p = np.exp(p - p.max(axis=1)[:, None])
        size = np.diff(t, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.where((p[:, 1:] > 0) & (p[:, :-1] > 0) & (size > 0), np.log(p[:, 1:] / p[:, :-1]) / size, 0.0)
            whole = np.where(np.abs(r) < 1e-12, size, np.expm1(r * size) / np.expm1(r))
        mass = np.cumsum(np.concatenate([p[:, :-1] * whole, p[:, -1:]], axis=1), axis=1)
        aim = rng.random(len(dish)) * mass[:, -1]
        cell = np.minimum((mass <= aim[:, None]).sum(axis=1), GRID - 1)
        inner = np.minimum(cell, GRID - 2)
        r, size = r[rows, inner], size[rows, inner]
        u = rng.random(len(dish))
        with np.errstate(divide="ignore", invalid="ignore"):
            inside = np.where(np.abs(r) < 1e-12, u * size, np.log1p(u * np.expm1(r * size)) / r)
        inside = np.where(cell < GRID - 1, np.clip(np.floor(inside), 0, np.maximum(size - 1, 0)), 0)
        out[dish] = (t[rows, cell] + inside).astype(np.int64)
    return out


def draw(c: np.ndarray, d: np.ndarray, logs: np.ndarray, group: np.ndarray, extra, rng: np.random.Generator, near: np.ndarray | None = None) -> np.ndarray:
    """t of each dish, with chances S_d(c, t) exp(extra(dish, t)); ``logs`` by group.
    ``near``: counts to look around first (any give the same chances)."""
    near = np.sqrt(c) if near is None else near
    out = np.empty(len(c), np.int64)
    for part, large in ((np.flatnonzero(c < STIRLING), False), (np.flatnonzero(c >= STIRLING), True)):
        if part.size:
            here = lambda i, t, part=part: extra(part[i], t)
            out[part] = draw_large(c[part], d[part], here, rng, near[part]) if large else draw_small(c[part], logs, group[part], here, rng)
    return out


def tables_of(discounts: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stirling tables of the ``used`` of some discounts and which of them each discount has."""
    kinds = np.unique(discounts[used])  # at most 91
    return np.stack([stirling(float(x)) for x in kinds]) if len(kinds) else np.zeros((0, 0, 0)), np.searchsorted(kinds, discounts)


def reseat(
    c: np.ndarray, t: np.ndarray, home: np.ndarray, d: np.ndarray, logs: np.ndarray, group: np.ndarray, tables: np.ndarray,
    c0: np.ndarray, t0: np.ndarray, d0: np.ndarray, logs0: np.ndarray, group0: np.ndarray, customers0: np.ndarray, rng: np.random.Generator,
) -> None:
    """Draws the tables ``t`` of all dishes anew, and with them the customers ``c0`` of the dishes above.

    ``home``: the dish above each, ascending. ``tables``: of each dish's restaurant.
    ``customers0``: of the restaurant of each dish above. Both stand still but for
    a dish's own part in them.
    """
    several = np.flatnonzero(c > 1)
    begins = np.searchsorted(home[several], home[several])
    rank = np.arange(len(several)) - begins
    order = np.argsort(rank, kind="stable")
    several, rank = several[order], rank[order]
    bounds = [0]
    while len(rank) and bounds[-1] <= rank[-1]:
        bounds.append(bounds[-1] + max(1, bounds[-1] // ALONE))
    cuts = np.searchsorted(rank, bounds)
    for low, high in zip(cuts[:-1], cuts[1:]):  # of the first below a dish one at a time
        i = several[low:high]
        h, own, was = home[i], d[i], t[i]
        parent = ParentSeatings(c0[h] - was, c[i], np.minimum(t0[h], c0[h]), d0[h], logs0, group0[h])
        others = STRENGTH / own + np.maximum(tables[i] - was, 0)
        above = STRENGTH + np.maximum(customers0[h] - was, 0)
        step = np.log(own)

        def extra(n, x, parent=parent, others=others, above=above, step=step):
            return x * step[n] + lgamma(others[n] + x) - lgamma(above[n] + x) + parent(n, x)

        t[i] = draw(c[i], own, logs, group[i], extra, rng, was)
        np.add.at(c0, h, t[i] - was)


class Totals:
    """Sums over all buckets, by restaurant: customers, tables, dishes with one
    and with two customers; the parent is the last; then the number of words."""

    def __init__(self, sums: np.ndarray):
        self.raw = np.asarray(sums, float)
        m = self.raw[: 4 * (CONTEXTS + 1)].reshape(4, CONTEXTS + 1)
        self.customers, self.tables = m[0], m[1]
        self.words = self.raw[-1]
        with np.errstate(invalid="ignore", divide="ignore"):
            d = m[2] / (m[2] + 2 * m[3])
        self.discount = np.clip(np.where(np.isfinite(d), d, 0.5), 0.05, 0.95).round(2)
        self.base = 1.0 / (self.words + 1.0)

    def parent(self, c0: np.ndarray, t0: np.ndarray) -> np.ndarray:
        """P0 of words with c0 customers at t0 tables (0, 0: unknown)."""
        d, c, t = self.discount[-1], self.customers[-1], self.tables[-1]
        return (np.maximum(c0 - d * t0, 0.0) + (STRENGTH + d * t) * self.base) / (STRENGTH + c)

    def chance(self, c0: np.ndarray, t0: np.ndarray, c: np.ndarray, t: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """P of pairs (word, context) from the seats of words at the parent and of pairs (0: none)."""
        own = (c - self.discount[context] * t) / (STRENGTH + self.customers[context])
        return own + self.share_of_parent()[context] * self.parent(c0, t0)[word]

    def share_of_parent(self) -> np.ndarray:
        return (STRENGTH + self.discount * self.tables)[:-1] / (STRENGTH + self.customers)[:-1]


class Restaurants:
    """All dishes of one bucket: pairs (word, context) with counts and tables."""

    def __init__(self, hashes, per_word, context, c, t, t0, samples):
        self.hashes, self.per_word, self.context = hashes, per_word.astype(np.int64), context.astype(np.int64)
        self.c, self.t, self.t0 = c.astype(np.int64), t.astype(np.int64), t0.astype(np.int64)
        self.samples: list[tuple[np.ndarray, np.ndarray]] = samples
        self.word = np.repeat(np.arange(len(hashes)), self.per_word)

    @classmethod
    def merge(cls, parts: list[bytes]) -> Restaurants:
        """From the words that all batches sent; only pairs seen in training."""
        read = [unpack(p) for p in parts]
        hashes = np.concatenate([r[0] for r in read])
        per_word = np.concatenate([r[1].astype(np.int64) for r in read])
        context = np.concatenate([r[2] for r in read]).astype(np.int64)
        counts = np.concatenate([r[3].astype(np.int64) for r in read])
        unique, place = np.unique(hashes, return_inverse=True)
        code = np.repeat(place, per_word) * CONTEXTS + context
        trained = counts > 0
        pair, inverse = np.unique(code[trained], return_inverse=True)
        c = np.bincount(inverse, weights=counts[trained], minlength=len(pair)).astype(np.int64)
        word = pair // CONTEXTS
        seen = np.unique(word)
        per = np.bincount(np.searchsorted(seen, word), minlength=len(seen))
        t = np.clip(np.rint(c**0.6), 1, c).astype(np.int64)
        c0 = np.bincount(np.searchsorted(seen, word), weights=t, minlength=len(seen))
        t0 = np.clip(np.rint(c0**0.6), 1, np.maximum(c0, 1)).astype(np.int64)
        return cls(unique[seen], per, pair % CONTEXTS, c, t, t0, [])

    def dump(self) -> bytes:
        flat = [smallest(a) for s in self.samples for a in s]
        return pack(self.hashes, smallest(self.per_word), smallest(self.context), smallest(self.c), smallest(self.t), smallest(self.t0), *flat)

    @classmethod
    def load(cls, data: bytes) -> Restaurants:
        a = unpack(data)
        return cls(*a[:6], [(a[i], a[i + 1]) for i in range(6, len(a), 2)])

    def customers0(self, t: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.word, weights=self.t if t is None else t, minlength=len(self.hashes))

    def totals(self) -> np.ndarray:
        c0 = self.customers0()
        rows = []
        for child, parent in ((self.c, c0), (self.t, self.t0), (self.c == 1, c0 == 1), (self.c == 2, c0 == 2)):
            rows.append(np.append(np.bincount(self.context, weights=child, minlength=CONTEXTS), parent.sum()))
        return np.append(np.concatenate(rows), len(self.hashes))

    def sums(self) -> tuple[list[int], list[float]]:
        """Places and values of the totals that aren't 0."""
        totals = self.totals()
        at = np.flatnonzero(totals)
        return at.tolist(), totals[at].tolist()

    def sweep(self, totals: Totals, rng: np.random.Generator) -> None:
        """Seats all customers of every dish anew, then those of the parent.

        Totals stand still but for the dish's own part in them.
        """
        d, d0 = totals.discount[:-1], float(totals.discount[-1])
        logs, group = tables_of(d, np.unique(self.context[self.c > 1]))
        logs0, n = stirling(d0), len(self.hashes)
        c0, began0, k = self.customers0().astype(np.int64), self.t0.copy(), self.context
        reseat(
            self.c, self.t, self.word, d[k], logs, group[k], totals.tables[k],
            c0, self.t0, np.full(n, d0), logs0[None], np.zeros(n, np.int64), np.full(n, totals.customers[-1]), rng,
        )
        many = np.flatnonzero(c0 > 1)
        tables0 = STRENGTH / d0 + np.maximum(totals.tables[-1] - began0[many], 0)
        step = np.log(d0 * totals.base)
        self.t0 = np.ones_like(self.t0)
        self.t0[many] = draw(c0[many], np.full(len(many), d0), logs0[None], np.zeros(len(many), np.int64), lambda n, t: t * step + lgamma(tables0[n] + t), rng, began0[many])

    def seats(self, hashes: np.ndarray, per_word: np.ndarray, context: np.ndarray, customers: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
        """For each sample customers and tables of words at the parent, and of pairs
        (word, context); 0 of those not known. ``customers``: of all dishes in each."""
        code = self.word * CONTEXTS + self.context
        at = look_up(self.hashes, np.arange(1, len(self.hashes) + 1), hashes)
        asked = np.repeat(at - 1, per_word) * CONTEXTS + context
        spot = look_up(code, np.arange(1, len(code) + 1), asked)
        ahead = lambda x: np.append(0, x)
        return [
            (ahead(self.customers0(t))[at], ahead(t0)[at], ahead(c)[spot], ahead(t)[spot])
            for (t, t0), c in zip(self.samples, customers)
        ]

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Customers of all dishes of each word."""
        total = np.bincount(self.word, weights=self.c, minlength=len(self.hashes))
        return look_up(self.hashes, total, hashes)

    def answer(self, part: bytes, sampled: list[Totals]) -> bytes:
        """For a part's words: counts; for its pairs: averaged probabilities."""
        hashes, per_word, context, _ = unpack(part)
        word, context = np.repeat(np.arange(len(hashes)), per_word), context.astype(np.int64)
        seats = self.seats(hashes, per_word, context, [self.c] * len(sampled))
        p = [totals.chance(*x, word, context) for x, totals in zip(seats, sampled)]
        return pack(smallest(self.counts(hashes)), np.log10(sum(p) / len(sampled)).astype(np.float32))


def look_up(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Integer values of ``asked`` among ascending ``known``, 0 of those not known."""
    if not len(known):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, values[at], 0).astype(np.int64)


def served(c: np.ndarray, fewer: np.ndarray, customers: np.ndarray, saved: np.ndarray, above: np.ndarray, discount: float) -> np.ndarray:
    """P(word | word before) from the pair's customers ``c`` at ``fewer`` tables less,
    those of the restaurant at ``saved`` tables less, and the chances of the one above."""
    return (c - discount * (c - fewer) + (STRENGTH + discount * (customers - saved)) * above) / (STRENGTH + customers)


class Pairs:
    """Pairs (word, word before) of one bucket from the arrays that all batches sent.

    ``hashes`` and ``names``: of words and of words before, ascending; ``pair``:
    codes (``len(names)`` * word + name) of those seen in training, ascending, ``c``
    their counts; ``dish``: codes (word, ending of the word before) of these,
    ``home`` the dish of each pair; ``several``: pairs of more than one customer by dish.
    """

    def __init__(self, parts: list[bytes]):
        self.read = [unpress(p) for p in parts]
        for r in self.read:
            r[0], r[4] = from_planes(r[0]), from_planes(r[4])
        self.hashes, place = np.unique(np.concatenate([r[0] for r in self.read]), return_inverse=True)
        self.names, first, name = np.unique(np.concatenate([r[4] for r in self.read]), return_index=True, return_inverse=True)
        self.endings = np.concatenate([r[5].astype(np.int64) for r in self.read])[first]
        self.asked, word_at, name_at = [], 0, 0
        for r in self.read:
            words, names = place[word_at : word_at + len(r[0])], name[name_at : name_at + len(r[4])]
            self.asked.append(np.repeat(words, r[1]) * len(self.names) + names[r[2]])
            word_at, name_at = word_at + len(r[0]), name_at + len(r[4])
        code, counts = np.concatenate(self.asked), np.concatenate([r[3].astype(np.int64) for r in self.read])
        trained = counts > 0
        self.pair, inverse = np.unique(code[trained], return_inverse=True)
        self.c = np.bincount(inverse, weights=counts[trained], minlength=len(self.pair)).astype(np.int64)
        self.word, self.name = np.divmod(self.pair, len(self.names))
        self.dish, self.home = np.unique(self.word * CONTEXTS + self.endings[self.name], return_inverse=True)
        several = np.flatnonzero(self.c > 1)
        self.several = several[np.argsort(self.home[several], kind="stable")]
        self.count = np.bincount(self.word, weights=self.c, minlength=len(self.hashes))


class Followers:
    """One bucket's dishes in the restaurants of words, over those of endings (``above``).

    Dishes of one customer stay as they are: ``ones`` of them send their table to
    each dish above. Of the others: ``home`` is the dish above, ``context`` the
    restaurant's place in ``names`` (hashes, by bucket). ``visits``: all customers
    of these restaurants; ``saved``: how many fewer tables they have.
    """

    def __init__(self, above: Restaurants, ones, names, visits, home, context, c, t, samples):
        self.above, self.ones, self.names, self.visits, self.home = above, ones.astype(np.int64), names, visits.astype(np.int64), home.astype(np.int64)
        self.context, self.c, self.t = context.astype(np.int64), c.astype(np.int64), t.astype(np.int64)
        self.saved = np.zeros(len(names), np.int64)
        self.samples: list[np.ndarray] = samples

    @classmethod
    def merge(cls, pairs: Pairs, buckets: int) -> Followers:
        t = np.clip(np.rint(pairs.c**0.6), 1, pairs.c).astype(np.int64)
        tables = np.bincount(pairs.home, weights=t, minlength=len(pairs.dish)).astype(np.int64)
        per_word = np.bincount(pairs.dish // CONTEXTS, minlength=len(pairs.hashes))
        above = Restaurants.merge([pack(pairs.hashes, per_word, pairs.dish % CONTEXTS, tables)])
        i = pairs.several
        ones = np.bincount(pairs.home, weights=pairs.c == 1, minlength=len(pairs.dish))
        used, context = np.unique(pairs.name[i], return_inverse=True)
        names = pairs.names[used]
        order = np.lexsort((names, bucket_of(names, buckets)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(above, ones, names[order], np.zeros(len(names)), pairs.home[i], place[context], pairs.c[i], t[i], [])

    def dump(self) -> bytes:
        arrays = (self.ones, self.visits, np.diff(self.home, prepend=0), self.context, self.c, self.t, *self.samples)
        return pack(np.frombuffer(self.above.dump(), np.uint8), self.names, *map(smallest, arrays))

    @classmethod
    def load(cls, data: bytes) -> Followers:
        above, names, ones, visits, home, context, c, t, *samples = unpack(data)
        return cls(Restaurants.load(above.tobytes()), ones, names, visits, np.cumsum(home.astype(np.int64)), context, c, t, samples)

    def customers(self, t: np.ndarray) -> np.ndarray:
        """Of the dishes above, with ``t`` tables here."""
        return self.ones + np.bincount(self.home, weights=t, minlength=len(self.ones)).astype(np.int64)

    def sums(self) -> tuple[list[int], list[float]]:
        """Places and values of the totals above that aren't 0, and from ``SIZE`` on customers and dishes of one and of two here."""
        at, values = self.above.sums()
        ones = int(self.ones.sum())
        return [*at, SIZE, SIZE + 1, SIZE + 2], [*values, float(self.c.sum() + ones), float(ones), float((self.c == 2).sum())]

    def sent(self, buckets: int) -> list[bytes | None]:
        """For each bucket, of its words' restaurants: tables that the dishes here save."""
        saved = np.bincount(self.context, weights=self.c - self.t, minlength=len(self.names)).astype(np.int64)
        cuts = np.searchsorted(bucket_of(self.names, buckets), np.arange(buckets + 1).astype(np.uint64))
        return [press(pack(planes(self.names[a:b]), smallest(saved[a:b]))) if a < b else None for a, b in zip(cuts[:-1], cuts[1:])]

    def hear(self, told: list[bytes]) -> None:
        """Sums over all buckets for ``names``: saved tables and, the first time, customers."""
        read = [unpress(x) for x in told]
        if sum(len(r[0]) for r in read) != len(self.names):
            raise ValueError("totals of restaurants are missing")
        if read:
            self.saved = np.concatenate([r[0] for r in read]).astype(np.int64)
            if len(read[0]) > 1:
                self.visits = np.concatenate([r[1] for r in read]).astype(np.int64)

    def sweep(self, totals: Totals, discount: float, rng: np.random.Generator) -> None:
        """Seats all customers of every dish anew, from the lowest level up."""
        above, d = self.above, totals.discount[:-1]
        k = above.context
        logs0, group0 = tables_of(d, np.unique(k[self.home]))
        n = len(self.c)
        above.c = self.customers(self.t)
        reseat(
            self.c, self.t, self.home, np.full(n, discount), stirling(discount)[None], np.zeros(n, np.int64), (self.visits - self.saved)[self.context],
            above.c, above.t, d[k], logs0, group0[k], totals.customers[k], rng,
        )
        above.t = np.minimum(above.t, above.c)
        above.sweep(totals, rng)

    def sample(self) -> None:
        self.samples.append(self.t)
        self.above.samples.append((self.above.t, self.above.t0))

    def answers(self, pairs: Pairs, saved: dict[int, bytes]) -> Iterator[bytes]:
        """Of each part: training counts of its words and of its pairs, then by sample
        saved tables and seats at the parent of its words, saved tables of its pairs,
        seats of its pairs of word and ending."""
        customers = [self.customers(t) for t in self.samples]
        fewer = []
        for t in self.samples:
            here = np.zeros(len(pairs.pair), np.int64)
            here[pairs.several] = self.c - t
            fewer.append(here)
        told = [unpress(saved[n]) if n in saved else [np.zeros(0, np.uint64)] * 2 for n in range(len(self.samples))]
        for r, asked in zip(pairs.read, pairs.asked):
            ends = pairs.endings[asked % len(pairs.names)]
            dish = np.unique(np.repeat(np.arange(len(r[0])), r[1]) * CONTEXTS + ends)
            seats = self.above.seats(r[0], np.bincount(dish // CONTEXTS, minlength=len(r[0])), dish % CONTEXTS, customers)
            arrays = [look_up(pairs.hashes, pairs.count, r[0]), look_up(pairs.pair, pairs.c, asked)]
            for (known, values), x, seat in zip(told, fewer, seats):
                arrays += [look_up(known, values, r[0]), *seat[:2], look_up(pairs.pair, x, asked), *seat[2:]]
            yield press(pack(*(smallest(x.astype(np.int64)) for x in arrays)))


# --- Spark ------------------------------------------------------------------


def _grouped(rows: DataFrame, key: str, order: list[str], body, ddl: str, schema: pa.Schema, parts: int) -> DataFrame:
    """``body(key, iterator of rows)`` for the rows of each key, in ``order``, streamed."""
    dealt = rows.repartition(parts, key).sortWithinPartitions(key, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        flat = (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
        for value, group in itertools.groupby(flat, key=lambda r: r[key]):
            for out in body(value, group):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema)], schema=schema)

    return dealt.mapInArrow(run, ddl)


STATE = pa.schema(
    [("bucket", pa.int32()), ("data", pa.binary()), ("at", pa.list_(pa.int32())), ("totals", pa.list_(pa.float64())), ("sent", pa.list_(pa.binary())), ("words", pa.binary())]
)
STATE_DDL = "bucket int, data binary, at array<int>, totals array<double>, sent array<binary>, words binary"
TOLD = pa.schema([("place", pa.int32()), ("src", pa.int32()), ("dst", pa.int32()), ("data", pa.binary())])
TOLD_DDL = "place int, src int, dst int, data binary"


def _write(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), path


def _sum(state: DataFrame) -> tuple[Totals, np.ndarray]:
    """Totals of endings; customers and dishes of one and of two in the restaurants of words."""
    cells = state.select(F.explode(F.arrays_zip("at", "totals")).alias("cell"))
    found = cells.groupBy(F.col("cell.at").alias("i")).agg(F.sum("cell.totals").alias("x")).toArrow()  # 4 numbers an ending in use
    sums = np.zeros(SIZE + 3)
    sums[found.column("i").to_numpy()] = found.column("x").to_numpy()
    return Totals(sums[:SIZE]), sums[SIZE:]


def _exchange(state: DataFrame, parts: int, first: bool) -> tuple[DataFrame, str]:
    """Rows (place, src, dst, data): what bucket ``dst`` sums of its words' restaurants,
    for the bucket ``src`` that asked, and with src -1 all of it. Those of a place
    lie in the file of that number (modulo ``parts``)."""
    rows = state.select(F.col("bucket").alias("src"), F.posexplode("sent").alias("dst", "data")).filter("data is not null")
    if first:
        rows = rows.union(state.select(F.lit(-1).alias("src"), F.col("bucket").alias("dst"), F.col("words").alias("data")))

    def tell(dst: int, rows) -> Iterator[tuple]:
        words, asked = None, []
        for r in rows:
            if r["src"] == -1:
                words = unpack(r["data"])
            else:
                own, values = unpress(r["data"])
                asked.append((r["src"], from_planes(own), values))
        if not asked:
            return
        names, place = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
        saved = np.bincount(place, weights=np.concatenate([a[2] for a in asked])).astype(np.int64)
        sums = [saved] if words is None else [saved, look_up(*words, names)]
        at = 0
        for src, own, _ in asked:
            here = place[at : at + len(own)]
            at += len(own)
            yield src, src, dst, press(pack(*(smallest(x[here]) for x in sums)))
        yield dst, -1, dst, press(pack(names, smallest(saved)))

    told = _grouped(rows, "dst", ["src"], tell, TOLD_DDL, TOLD, parts)
    return _write(told.repartitionById(parts, F.pmod("place", F.lit(parts)).cast("int")).sortWithinPartitions("src", "dst"), "told")


class Told:
    """What ``_exchange`` wrote, read in a task by bucket."""

    def __init__(self, path: str, parts: int):
        from pyarrow import fs

        self.store, root = open_store(path)
        self.parts, self.files = parts, {}
        for f in self.store.get_file_info(fs.FileSelector(root)):
            if f.base_name.startswith("part-"):
                self.files.setdefault(int(f.base_name.split("-")[1]), []).append(f.path)

    def __call__(self, bucket: int) -> list[bytes]:
        import pyarrow.parquet as pq

        out = []
        for path in self.files.get(bucket % self.parts, []):
            table = pq.read_table(path, columns=["src", "dst", "data"], filesystem=self.store, partitioning=None)
            out += [(dst, data) for src, dst, data in zip(*(c.to_pylist() for c in table.columns)) if src == bucket]
        return [data for _, data in sorted(out)]


def score_documents(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", modulus: int = 7, fold: int = 2, seed: int = 0, samples: int = SAMPLES
) -> DataFrame:
    """Scores of all texts under a model of those outside ``fold``.

    Returns key, held_out, n_tokens, n_known, train_tokens, base_score (log10,
    add-one unigram) and score (log10, this model). Perplexity of a text is
    ``10 ** (-score / n_tokens)``.

    Null and empty texts: one token, the end. Null keys: of no bytes when the
    fold is drawn, null in the result. Tied and repeated rows are texts of
    their own. Very long texts are scored whole. Empty table: no rows; no
    training text: every word is unknown. Extra columns are not read. Keys
    are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(fill(text)))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    parts = int(min(buckets, 100_000))
    made, _ = _write(tokenized(docs, key=key, text=text, modulus=modulus, fold=fold, buckets=buckets), "batches")
    words, texts = made.filter("bucket >= 0"), made.filter("bucket = -1")

    def merge(bucket, rows):
        pairs = Pairs([r["data"] for r in rows])
        state = Followers.merge(pairs, buckets)
        trained = pairs.count > 0
        yield bucket, state.dump(), *state.sums(), state.sent(buckets), pack(pairs.hashes[trained], smallest(pairs.count[trained]))

    state, path = _write(_grouped(words, "bucket", ["batch"], merge, STATE_DDL, STATE, parts), "state")
    totals, (n_train, ones, twos) = _sum(state)
    discount = float(np.clip(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.05, 0.95).round(2))
    release(spark)
    told, told_path = _exchange(state, parts, True)
    told_paths = [told_path]
    sampled: list[tuple[Totals, DataFrame]] = []
    for n in range(BURN_IN + samples):

        def sweep(batches: Iterator[pa.RecordBatch], n: int = n, totals: Totals = totals, told_path: str = told_path) -> Iterator[pa.RecordBatch]:
            told = None
            for batch in batches:
                for r in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                    told = told or Told(told_path, parts)
                    rng = np.random.default_rng([seed, n, r["bucket"]])
                    here = Followers.load(r["data"])
                    here.hear(told(r["bucket"]))
                    here.sweep(totals, discount, rng)
                    if n >= BURN_IN:
                        here.sample()
                    row = (r["bucket"], here.dump(), *here.sums(), here.sent(buckets), None)
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, STATE)], schema=STATE)

        state, after = _write(state.select("bucket", "data").mapInArrow(sweep, STATE_DDL), "state")
        drop_copy(spark, path)
        path, (totals, _) = after, _sum(state)
        told, told_path = _exchange(state, parts, False)
        told_paths.append(told_path)
        if n >= BURN_IN:
            sampled.append((totals, told))
    n_train, n_words = int(n_train), int(totals.words)
    of_endings = [x for x, _ in sampled]

    asked = words.select("bucket", "batch", "data").union(state.select("bucket", F.lit(-1 - samples).cast("long").alias("batch"), "data"))
    for n, (_, told) in enumerate(sampled):
        asked = asked.union(told.filter("src = -1").select("dst", F.lit(n - samples).cast("long"), "data"))

    def answer(bucket, rows):
        here, saved, names, data = None, {}, [], []
        for r in rows:  # the state comes first, then the samples' sums
            if r["batch"] == -1 - samples:
                here = Followers.load(r["data"])
            elif r["batch"] < 0:
                saved[r["batch"] + samples] = r["data"]
            else:
                names.append(r["batch"])
                data.append(r["data"])
        for batch, found in zip(names, here.answers(Pairs(data), saved)):
            yield batch, bucket, found

    ANSWER = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
    release(spark)
    answers = _grouped(asked, "bucket", ["batch"], answer, "batch long, bucket int, data binary", ANSWER, parts)
    answers, _ = _write(answers, "answers")
    drop_copy(spark, path)
    for x in told_paths:
        drop_copy(spark, x)
    release(spark)
    both = answers.select("batch", "bucket", "data").union(texts.select("batch", F.lit(2**31 - 1).alias("bucket"), "data"))
    log_unseen = -np.log10(n_train + n_words + 1.0)

    def score(batch, rows):
        found = []
        for r in rows:  # the texts come last
            if r["bucket"] != 2**31 - 1:
                found.append(unpress(r["data"]))
                continue
            keys, flags, lengths, start, low, high, often, contexts = unpress(r["data"])
            count, c, *arrays = (np.concatenate(x).astype(np.float64) for x in zip(*found))
            numbers = low.astype(np.int64) | (high.astype(np.int64) << 16)
            place, endings = often.astype(np.int64)[numbers], np.empty(len(often), np.int64)
            endings[often] = contexts
            pair, token, starts = pairs_of(place, int(start[0]), len(often), lengths)
            word, before = np.divmod(pair, len(often))
            ends, dish = np.unique(word * CONTEXTS + endings[before], return_inverse=True)
            p = []
            for n, totals in enumerate(of_endings):
                saved, c0, t0, fewer, c1, t1 = arrays[6 * n : 6 * n + 6]
                above = totals.chance(c0, t0, c1, t1, ends // CONTEXTS, ends % CONTEXTS)
                p.append(served(c, fewer, count[before], saved[before], above[dish], discount))
            log = np.log10(sum(p) / samples)
            per_word = np.log10(count + 1.0) + log_unseen
            columns = (
                np.add.reduceat((count[place] > 0).astype(np.int64), starts),
                np.add.reduceat(per_word[place], starts),
                np.add.reduceat(log[token], starts),
            )
            yield keys, flags, lengths, columns

    dealt = both.repartition(int(max(8, min(buckets, 100_000))), "batch").sortWithinPartitions("batch", "bucket")
    out = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        flat = (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
        for value, group in itertools.groupby(flat, key=lambda r: r["batch"]):
            for keys, flags, lengths, (known, base, total) in score(value, group):
                null = (flags & 1).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=null), pa.array((flags & 2) > 0), pa.array(lengths), pa.array(known), pa.array(base), pa.array(total)], schema=out
                )

    scored = dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; fold 2 of 7 is never learned from."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
