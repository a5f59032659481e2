import numpy as np
import pytest
from awkward_rows import AWKWARD, awkward, nothing  # noqa: F401

from propensia.llm import token_slots as ts
from propensia.llm import tokens
from propensia.llm.common import scratch_path


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    slots = ts.permute(np.arange(n), n, 9)
    assert sorted(slots.tolist()) == list(range(n))
    assert (ts.permute(slots, n, 9, inverse=True) == np.arange(n)).all()
    if n > 60:
        assert (ts.permute(np.arange(n), n, 10) != slots).any()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.35


def expected(length):
    encode = tokens.encoder(tokens.default_path())
    out = []
    for k, t in AWKWARD:
        ids = [*encode(t or "").tolist(), 1]
        out += [(k, s, ids[s : s + length]) for s in range(0, len(ids), length)]
    return out


def test_round_trip_and_resumable_reads(spark, awkward):  # noqa: F811
    path = scratch_path(spark, "test-shards")
    layout = ts.write_shards(awkward, path, length=64, per_shard=32)
    want = expected(64)
    assert layout["sequences"] == len(want)
    rows = ts.read_slots(spark, path, layout).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(want)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in rows:
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 32, r["slot"] % 32 * layout["stride"])
    part = ts.read_slots(spark, path, layout, 40, 75).collect()
    assert sorted(r["slot"] for r in part) == list(range(40, 75))
    again = scratch_path(spark, "test-shards")
    ts.write_shards(awkward, again, length=64, per_shard=32)
    assert {tuple(r) for r in ts.read_slots(spark, again, layout).collect()} == {tuple(r) for r in rows}


def test_files_hold_disjoint_slot_ranges_and_reads_open_only_theirs(spark):
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, f"text {i} " * (i % 40)) for i in range(900)], "doc_id long, text string").repartition(5)
    path = scratch_path(spark, "test-shards")
    layout = ts.write_shards(docs, path, length=16, per_shard=8, shards_per_file=5)
    per_file = 8 * layout["per_file"]
    ranges = {}
    for name in spark.read.parquet(path).inputFiles():
        meta = pq.read_metadata(name.removeprefix("file:").replace("///", "/"))
        found = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
        number = int(name.rsplit("/", 1)[1].split("-")[1])
        assert min(s.min for s in found) == number * layout["per_file"]
        assert max(s.max for s in found) < (number + 1) * layout["per_file"]
        ranges[number] = name
    assert sorted(ranges) == list(range(-(-layout["sequences"] // per_file))) and len(ranges) > 5
    first, last = 2 * per_file + 3, 4 * per_file + 1
    part = ts.read_slots(spark, path, layout, first, last)
    assert sorted(part.inputFiles()) == sorted(ranges[n] for n in (2, 3, 4))
    assert sorted(r["slot"] for r in part.collect()) == list(range(first, last))
    whole = {tuple(r) for r in ts.read_slots(spark, path, layout).collect()}
    assert {tuple(r) for r in part.collect()} == {r for r in whole if first <= r[0] < last}
    assert len(whole) == layout["sequences"] and ts.read_slots(spark, path, layout, 7, 7).count() == 0
    end = ts.read_slots(spark, path, layout, layout["sequences"] - 2, layout["sequences"] + 50)
    assert end.count() == 2 and len(end.inputFiles()) == 1


def test_empty_table(spark, nothing):  # noqa: F811
    path = scratch_path(spark, "test-shards")
    layout = ts.write_shards(nothing, path)
    assert layout["sequences"] == 0 and ts.read_slots(spark, path, layout).count() == 0
