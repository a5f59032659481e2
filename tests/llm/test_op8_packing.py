import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401
from conftest import SF0001
from tokenizers import Tokenizer

from propensia.llm import packing, tokens


def test_ids_equal_the_library(spark):
    library = Tokenizer.from_file(tokens.default_path())
    encode = tokens.encoder(tokens.default_path())
    texts = [r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    texts += [t or "" for _, t in AWKWARD if t is None or len(t) < 50_000]
    texts += ["a\r\n\r\n b", "I'll we've it's", "１２３ ²³", "   　x", "́é", "don't<|endoftext|>"]
    for t in texts:
        assert encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t[:80]


def cost(docs, ends, window, soft, hard):
    """Cheapest packing by trying all windows (quadratic)."""
    places, costs, total = [0], [0.0], 0
    for ids in docs:
        p, c = packing.cut_places(ids, ends, window, soft, hard)
        places += (p + total).tolist()
        costs += c.tolist()
        total += len(ids)
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= window:
                best[j] = min(best[j], best[i] + window - (places[j] - places[i]) + costs[j])
    return best[-1], dict(zip(places, costs))


@pytest.mark.parametrize("seed", range(12))
def test_packing_is_optimal(seed):
    rng = random.Random(seed)
    window, ends = 32, np.array([i % 5 == 0 for i in range(50)])
    docs = [np.array([rng.randrange(50) if rng.random() < 0.6 else 1 for _ in range(rng.choice([1, 3, 20, 90, 200]))], np.uint32) for _ in range(15)]
    for block in (1, 64, 1 << 17):  # handing out early changes nothing
        pieces = list(packing.pack_stream(enumerate(docs), window, ends, 2.0, 9.0, block=block))
        fills = defaultdict(int)
        for k, start, ids, n, sequence, offset, filled in pieces:
            assert offset == fills[sequence] and n == len(docs[k])
            assert ids.tolist() == docs[k][start : start + len(ids)].tolist()
            fills[sequence] += len(ids)
            assert fills[sequence] <= filled <= window
        assert [i for _, _, ids, *_ in pieces for i in ids.tolist()] == [i for d in docs for i in d.tolist()]
        best, costs = cost(docs, ends, window, 2.0, 9.0)
        borders = np.cumsum([fills[s] for s in sorted(fills)])
        assert sum(window - f for f in fills.values()) + sum(costs[int(b)] for b in borders) == pytest.approx(best)


def check(rows, docs):
    encode, pieces = tokens.encoder(tokens.default_path()), defaultdict(list)
    want = sorted(str([*encode(t or "").tolist(), 1]) for _, t in docs)
    fills = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        fills[r["sequence_id"]].append((r["offset"], r["length"], r["padded_to"]))
    for parts in fills.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and {p for *_, p in parts} == {packing.padded_length(at, 2048)}
    whole = []
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        if r["start"] == 0:
            pieces["open"] = []
        assert len(pieces["open"]) == r["start"]
        pieces["open"] = pieces["open"] + ids
        if len(pieces["open"]) == r["doc_tokens"]:
            whole.append(str(pieces["open"]))
    assert sorted(whole) == want
    return fills


def test_awkward_rows_and_empty_table(spark, awkward, nothing):  # noqa: F811
    check(packing.pack_documents(awkward, with_ids=True).collect(), AWKWARD)
    assert packing.pack_documents(nothing).count() == 0


def test_whole_table_has_little_padding(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    fills = check(packing.pack_documents(docs, with_ids=True).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    used = [sum(n for _, n, _ in parts) for parts in fills.values()]
    assert 1 - sum(used) / (2048 * len(used)) < 0.03
