"""Training-order materialisation of token sequences.

Documents become sequences of ``length`` ids. A keyed Feistel permutation of
0 .. N-1 (cycle-walking: values that fall outside are permuted again) gives
every sequence its global slot, so the training order is a pseudo-random
shuffle that needs no sort key to be stored, can be inverted and is the same
on every run. Slots are cut into ranges of ``per_shard`` records; a range
becomes one shard, a binary of fixed-stride records, so slot s lies in shard
``s // per_shard`` at byte ``(s % per_shard) * stride`` and reading can begin
or resume anywhere.

How it runs: one scan encodes the texts and writes the sequences with their
running number inside the scan partition; the driver reads one count per
partition and hands back the partitions' first numbers, which makes the
numbering dense without a sort; one shuffle deals the slots by ranges: task r
gets the shards from ``r * shards_per_file`` on, sorted by slot, and writes them
as the Parquet rows of one file, ``part-r-...``. So a slot range lies in the
files of consecutive numbers, and a reader opens only those. Spark's own
committer writes, so a lost executor costs a task and any store that Spark
writes can hold the shards.

Record: magic ``SQ`` (2 bytes), flags (1: key is null), id width, number of
ids u32, slot u64, key i64, place of the sequence in its document u64 (ids
before it), ids, zero bytes up to the stride; all little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm import tokens
from propensia.llm.common import fill, literal_table, materialize, scratch_path, ship

HEAD = "<2sBBIQqQ"
HEAD_SIZE = struct.calcsize(HEAD)
ROUNDS = 6
SHARD_DDL = "shard long, first_slot long, records int, crc32 long, data binary"
NAMED_FILES = 512  # of a range that are listed one by one


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit avalanche of ``x`` under ``key`` (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64(key & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _round_keys(key: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), key)]


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n-1 (or its inverse) at each index.

    The network works on the smallest even number of bits that holds n, at
    most four times n values; results of n or more go through it again.
    """
    h = _half_bits(n)
    bits, mask = np.uint64(h), np.uint64((1 << h) - 1)
    keys = _round_keys(key)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left, k) & mask), left
            else:
                left, right = right, left ^ (_mix(right, k) & mask)
        return (left << bits) | right

    out = network(np.asarray(index, dtype=np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = network(out[far])
    return out.astype(np.int64)


def sequences(docs: DataFrame, *, key: str, text: str, length: int, end_id: int, tokenizer: str) -> DataFrame:
    """Sequences with the scan partition and their running number in it."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("k"), fill(text).alias("t"), F.spark_partition_id().alias("p"))
    schema = pa.schema(
        [("part", pa.int32()), ("at", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()),
         ("n", pa.int32()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at = tokens.encoder(tokenizer), 0
        wide = tokens.vocabulary(tokenizer)[2] > 1 << 16
        for batch in batches:
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                ids = np.append(encode(batch.column(1)[i].as_py()), np.uint32(end_id))
                k, part = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    rows.append((part, at, k, start, len(ids), len(piece), piece.astype("<u4" if wide else "<u2").tobytes()))
                    at += 1
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return narrow.mapInArrow(run, "part int, at long, key long, start long, doc_tokens long, n int, ids binary")


def write_shards(
    docs: DataFrame,
    path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = 512,
    per_shard: int = 512,
    shards_per_file: int = 1024,
    seed: int = 17,
    end_id: int = 1,
    tokenizer: str | None = None,
) -> dict:
    """Write all sequences of ``docs`` in training order below ``path``.

    Returns the layout: number of sequences, stride, records a shard, shards a
    file, seed. A file holds ``shards_per_file`` shards (about half a GB), fewer
    where that leaves cores idle; no slot depends on it.

    Null text: read as empty, one sequence with the end id. Null, tied or
    repeated keys: each row's sequences are written (the record flags a null
    key). Very long texts: many sequences. Empty table: no shard. Extra
    columns are not read. Keys are integers.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.default_path()
    made = materialize(sequences(docs, key=key, text=text, length=length, end_id=end_id, tokenizer=tokenizer), "sequences")
    counts = {r["part"]: r["n"] for r in made.groupBy("part").agg(F.count("*").alias("n")).collect()}
    firsts, total = [], 0
    for part in sorted(counts):
        firsts.append({"part": part, "first": total})
        total += counts[part]
    width = 4 if tokens.vocabulary(tokenizer)[2] > 1 << 16 else 2
    shards = -(-total // per_shard)
    per_file = max(1, min(shards_per_file, -(-shards // (4 * spark.sparkContext.defaultParallelism))))
    files = max(1, -(-shards // per_file))
    layout = {"sequences": total, "stride": HEAD_SIZE + width * length, "per_shard": per_shard, "per_file": per_file, "seed": seed, "length": length}

    @F.pandas_udf("long")
    def slot_of(index):
        import pandas as pd

        return pd.Series(permute(index.to_numpy(), total, seed))

    table = literal_table(spark, firsts, "part int, first long")  # one row per scan partition, as the driver has anyway
    slotted = made.join(F.broadcast(table), "part").withColumn("slot", slot_of(F.col("first") + F.col("at")))
    slotted = slotted.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
    narrow = slotted.select("shard", "slot", "key", "start", "n", "ids")
    dealt = narrow.repartitionById(files, F.floor(F.col("shard") / per_file).cast("int")).sortWithinPartitions("slot")
    schema = pa.schema([("shard", pa.int64()), ("first_slot", pa.int64()), ("records", pa.int32()), ("crc32", pa.int64()), ("data", pa.binary())])
    stride = layout["stride"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []

        def close() -> pa.RecordBatch:
            data = b"".join(parts)
            row = (shard, shard * per_shard, len(parts), zlib.crc32(data), data)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    if parts:
                        yield close()
                    shard, parts = r["shard"], []
                flags = int(r["key"] is None)
                head = struct.pack(HEAD, b"SQ", flags, width, r["n"], r["slot"], r["key"] or 0, r["start"])
                parts.append((head + r["ids"]).ljust(stride, b"\0"))
        if parts:
            yield close()

    made = dealt.mapInArrow(run, SHARD_DDL)
    made.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return layout


def read_slots(spark: SparkSession, path: str, layout: dict, first: int = 0, last: int | None = None) -> DataFrame:
    """The records of slots first .. last-1: slot, doc_id, start, length, ids, place.

    Only files of the range are opened (all of them are listed by their numbers,
    if that is at most ``NAMED_FILES``; else the files' statistics decide), and of
    them only shards that overlap it are decoded; inside a shard the first record
    is found by its offset. An empty range: no rows.
    """
    ship(spark)
    last = layout["sequences"] if last is None else min(last, layout["sequences"])
    per, stride = layout["per_shard"], layout["stride"]
    low, high = first // per, max(last - 1, 0) // per
    numbers = range(low // layout["per_file"], high // layout["per_file"] + 1)
    named = first < last and len(numbers) <= NAMED_FILES
    paths = [f"{path.rstrip('/')}/part-{n:05d}-*" for n in numbers] if named else [path]
    wanted = spark.read.schema(SHARD_DDL).parquet(*paths).filter((F.col("shard") >= low) & (F.col("shard") <= high))
    schema = pa.schema(
        [("slot", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("shard", pa.int64()), ("byte_offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data, rows = r["data"], []
                if zlib.crc32(data) != r["crc32"] or len(data) != r["records"] * stride:
                    raise ValueError(f"shard {r['shard']} is damaged")
                for slot in range(max(first, r["first_slot"]), min(last, r["first_slot"] + r["records"])):
                    at = (slot - r["first_slot"]) * stride
                    magic, flags, width, n, own, key, start = struct.unpack_from(HEAD, data, at)
                    if magic != b"SQ" or own != slot:
                        raise ValueError(f"slot {slot} is damaged")
                    ids = np.frombuffer(data, f"<u{width}", n, at + HEAD_SIZE).astype("<u4").tobytes()
                    rows.append((slot, None if flags & 1 else key, start, n, ids, r["shard"], at))
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return wanted.mapInArrow(run, "slot long, doc_id long, start long, length long, ids binary, shard long, byte_offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written in training order and read back, a row per sequence."""
    path = scratch_path(spark, "shards")
    layout = write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    rows = read_slots(spark, path, layout)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "slot", "shard", "byte_offset")
