"""Order-preserving packing of documents into token windows.

The documents of a scan partition, in their order, are one stream of ids; a
packing is a set of cuts in it such that every window holds at most ``window``
ids. Cuts are free between documents, cost ``sentence_cut`` after a sentence
inside a document and ``hard_cut`` elsewhere; each id of padding costs 1.
Dynamic programming over the possible cuts finds the cheapest packing:

    best(j) = cut(j) + window - at(j) + min over i of (best(i) + at(i)),
    at(j) - window <= at(i) < at(j)

and as the lower border moves forward only, a monotone queue gives the
minimum in constant time. A stream is never held whole: once all open ends
agree on an earlier cut (they nearly always do within a few windows), the
windows before it are final and are handed out.

Partitions are independent, so there is no shuffle; a lost task repeats its
own scan and gives the same windows and ids. A partition's last window alone
can be short for lack of ids.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm import tokens
from propensia.llm.common import fill, ship

END_ID = 1  # follows every document
SCHEMA = (
    "doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long"
)


def cut_places(ids: np.ndarray, ends: np.ndarray, window: int, sentence_cut: float, hard_cut: float):
    """(positions, costs) of the cuts inside and after one document of ``ids``.

    Sentences longer than an eighth of the window also get hard cuts every
    sixteenth of it.
    """
    n = len(ids)
    soft = np.flatnonzero(ends[ids[: n - 1]]) + 1 if n > 1 else np.zeros(0, dtype=np.int64)
    places = np.append(soft[soft < n], n).astype(np.int64)
    costs = np.full(len(places), float(sentence_cut))
    costs[-1] = 0.0
    step, widest = max(1, window // 16), max(1, window // 8)
    gaps = np.diff(places, prepend=0)
    if (wide := np.flatnonzero(gaps > widest)).size:
        extra = np.concatenate([np.arange(places[k] - gaps[k] + step, places[k], step) for k in wide])
        places, costs = np.append(places, extra), np.append(costs, np.full(len(extra), float(hard_cut)))
        order = np.argsort(places, kind="stable")
        places, costs = places[order], costs[order]
    return places, costs


class WindowCuts:
    """The dynamic programme over one stream; feed cuts in order, take windows."""

    def __init__(self, window: int):
        self.window = window
        self.at, self.best, self.prev = [0], [0.0], [-1]
        self.queue: deque[int] = deque([0])

    def feed(self, places: Iterable[int], costs: Iterable[float]) -> None:
        at, best, prev, queue, window = self.at, self.best, self.prev, self.queue, self.window
        for place, cost in zip(places, costs, strict=True):
            floor = place - window
            while at[queue[0]] < floor:
                queue.popleft()
            i = queue[0]
            value = best[i] + at[i] + cost + window - place
            j = len(at)
            at.append(place)
            best.append(value)
            prev.append(i)
            key = value + place
            while queue and best[queue[-1]] + at[queue[-1]] > key:
                queue.pop()
            queue.append(j)

    def _walk(self, j: int) -> list[int]:
        cuts = []
        while j > 0:
            cuts.append(self.at[j])
            j = self.prev[j]
        return cuts[::-1]

    def settled(self) -> list[int]:
        """Cuts that every continuation shares; they are forgotten here."""
        last = self.at[-1]
        open_ends = {j for j in range(len(self.at) - 1, -1, -1) if self.at[j] >= last - self.window}
        while len(open_ends) > 1:
            open_ends.add(self.prev[top := max(open_ends)])
            open_ends.discard(top)
            open_ends.discard(-1)
        (root,) = open_ends or {0}
        cuts = self._walk(root)
        if root > 0:
            self.queue = deque(j - root for j in self.queue if j >= root)
            self.at, self.best = self.at[root:], self.best[root:]
            self.prev = [-1, *(p - root for p in self.prev[root + 1 :])]
        return cuts

    def finish(self) -> list[int]:
        return self._walk(len(self.at) - 1)


def padded_length(filled: int, window: int) -> int:
    """Sequences are padded to ``window``, except at a power of two."""
    return filled if filled & (filled - 1) == 0 else window


def pack_stream(
    docs: Iterable[tuple[object, np.ndarray]], window: int, ends: np.ndarray, sentence_cut: float, hard_cut: float,
    first_sequence: int = 0, block: int = 1 << 17,
) -> Iterator[tuple]:
    """(key, start, ids of the piece, document length, sequence, offset, fill of the sequence)."""
    cuts = WindowCuts(window)
    held: deque[tuple[object, np.ndarray, int]] = deque()  # key, ids, where the document starts in the stream
    total, done, fed, sequence = 0, 0, 0, first_sequence

    def hand_out(borders: list[int]) -> Iterator[tuple]:
        nonlocal done, sequence
        for border in borders:
            low = done
            while low < border:
                key, ids, first = held[0]
                high = min(border, first + len(ids))
                yield key, low - first, ids[low - first : high - first], len(ids), sequence, low - done, border - done
                if high == first + len(ids):
                    held.popleft()
                low = high
            done, sequence = border, sequence + 1

    for key, ids in docs:
        places, costs = cut_places(ids, ends, window, sentence_cut, hard_cut)
        cuts.feed((places + total).tolist(), costs.tolist())
        held.append((key, ids, total))
        total += len(ids)
        if total - fed >= block:
            fed = total
            yield from hand_out(cuts.settled())
    yield from hand_out(cuts.finish())


def pack_documents(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = 2048,
    sentence_cut: float = 4.0,
    hard_cut: float = 64.0,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pack every document's ids (then ``end_id``) into windows; a row per piece.

    Order is kept inside each scan partition. ``with_ids`` adds the piece's
    ids as little-endian unsigned 32-bit values.

    Null text: read as empty, one piece with the end id. Very long texts: cut
    into as many windows as they need. Null, tied or repeated keys: every row
    is packed by itself. Empty table: no rows. Extra columns are not read.
    """
    ship(docs.sparkSession)
    path = tokenizer or tokens.default_path()
    kind = docs.schema[key].dataType
    names = F.col(key).alias("doc_id"), fill(text).alias("text"), F.spark_partition_id().alias("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = tokens.encoder(path), tokens.sentence_ends(path)
        ends = np.append(ends, np.zeros(max(0, end_id + 1 - len(ends)), dtype=bool))
        part = 0

        def stream():
            nonlocal part
            for batch in batches:
                if batch.num_rows:
                    part = batch.column(2)[0].as_py()
                keys = batch.column(0)
                for i in range(batch.num_rows):
                    yield keys[i].as_py(), np.append(encode(batch.column(1)[i].as_py()), np.uint32(end_id))

        rows: list[tuple] = []
        for k, start, ids, n, sequence, offset, filled in pack_stream(stream(), window, ends, sentence_cut, hard_cut):
            raw = ids.astype("<u4").tobytes()
            head = (k, start, len(ids), zlib.crc32(raw), n, (part << 33) | sequence, offset, padded_length(filled, window))
            rows.append((*head, raw) if with_ids else head)
            if len(rows) >= 8192:
                yield _batch(rows, out)
                rows = []
        if rows:
            yield _batch(rows, out)

    out = _arrow(kind, with_ids)
    ddl = SCHEMA.format(key=kind.simpleString()) + (", ids binary" if with_ids else "")
    return docs.select(*names).mapInArrow(run, ddl)


def _arrow(kind, with_ids: bool) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    fields = [("doc_id", to_arrow_type(kind))]
    fields += [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to")]
    return pa.schema(fields + [("ids", pa.binary())] * with_ids)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into sequences of at most 2048 ids."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

