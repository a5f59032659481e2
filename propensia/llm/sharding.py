"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` positions on a 64-bit ring. A row's key is hashed
onto the ring and belongs to the first virtual node at or after it (wrapping
round). A shard takes rows up to its capacity; the rows beyond it walk on
clockwise to the next virtual node whose shard has room, so no shard exceeds
its bound and rows that fit stay where the ring alone would put them.

How it runs: one scan maps each row to its arc (a broadcast equi-join on the
ring cell, then a range test) and writes the narrow columns to the shared
folder. The only thing the driver sees is the row count of every
(arc, part of an arc): ``shards * vnodes * parts`` numbers at most, set by
parameters. From these counts it derives which rank interval of which part
goes to which shard and at which slot it starts; one window ranks the rows
inside (arc, part) and one broadcast join hands out shard and slot.

An arc's rows are split into ``parts`` by a hash of key and content, so a key
shared by many different rows is still ranked in several tasks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensia.llm.common import fill, literal_table, materialize

#: ``law`` of the default capacities: shard sizes in rows differ by one at most.
LAW_ROWS = "rows"


def ring_positions(spark: SparkSession, shards: int, vnodes: int, seed: int) -> list[tuple[int, int]]:
    """Sorted (position, shard); a shard's positions don't depend on ``shards``."""
    nodes = spark.range(shards * vnodes, numPartitions=1).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("replica")
    )
    rows = nodes.select(F.xxhash64(F.lit(seed), F.lit("node"), "shard", "replica").alias("p"), "shard").collect()
    return sorted((r["p"], r["shard"]) for r in rows)


def ring_cells(ring: Sequence[tuple[int, int]]) -> tuple[int, list[dict]]:
    """(shift, pieces): the arcs cut at the borders of equal ring cells.

    A key lies in cell ``position >> shift`` and in exactly one piece of it,
    so finding its arc is an equi-join on the cell plus a range test.
    """
    bits = max(4, (4 * len(ring)).bit_length())
    shift = 64 - bits
    ends = [p for p, _ in ring]
    pieces = []
    for cell in range(-(1 << (bits - 1)), 1 << (bits - 1)):
        low, high = cell << shift, ((cell + 1) << shift) - 1
        while low <= high:
            at = bisect_left(ends, low)
            top = min(high, ends[at]) if at < len(ends) else high
            pieces.append({"cell": cell, "lo": low, "hi": top, "arc": at % len(ends)})
            low = top + 1
    return shift, pieces


def capacities(rows: int, shards: int, load_factor: float) -> list[int]:
    """Rows that each shard takes: at factor 1 exactly its even share."""
    if load_factor < 1:
        raise ValueError("load_factor below 1 leaves rows without a shard")
    if load_factor == 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(-(-rows * load_factor // shards))] * shards


def place(ring: Sequence[tuple[int, int]], counts: dict[tuple[int, int], int], room: list[int]) -> list[dict]:
    """Rank intervals [lo, hi) of each (arc, part) with their shard and first slot.

    Rows arrive in ring order. First every virtual node takes what fits from
    its own arc, then the overflow walks clockwise, arc by arc.
    """
    room, slots, plan, late = list(room), [0] * len(room), [], []

    def put(arc: int, part: int, low: int, high: int, shard: int) -> int:
        take = min(high - low, room[shard])
        if take:
            plan.append({"arc": arc, "part": part, "lo": low, "hi": low + take, "shard": shard, "base": slots[shard]})
            room[shard] -= take
            slots[shard] += take
        return low + take

    for arc, part in sorted(counts):
        n = counts[arc, part]
        if (low := put(arc, part, 0, n, ring[arc][1])) < n:
            late.append((arc, part, low, n))
    for arc, part, low, n in late:
        node = arc
        while low < n:
            node = (node + 1) % len(ring)
            low = put(arc, part, low, n, ring[node][1])
    return plan


def shard_rows(
    docs: DataFrame,
    shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    vnodes: int = 128,
    load_factor: float = 1.0,
    parts: int = 8,
    seed: int = 0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Assign every row of ``docs`` to a shard and a gapless slot inside it.

    Returns key, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``,
    ``shard``, ``slot``, ``home`` (the shard the plain ring would have chosen)
    and the columns in ``keep``.

    Null key: hashed like a value of its own. Null text: size 1, crc 0.
    Repeated rows: each is placed; rows equal in key and text are
    interchangeable. Empty table: no rows. Extra columns are ignored unless
    kept; inner names are prefixed and cannot clash. Texts are only measured.
    Rows equal in key AND text share one part of one arc.
    """
    spark = docs.sparkSession
    ring = ring_positions(spark, shards, vnodes, seed)
    shift, pieces = ring_cells(ring)
    shard_of = literal_table(spark, [{"arc": a, "home": s} for a, (_, s) in enumerate(ring)], "arc int, home int")
    body = fill(text)
    rows = docs.select(
        F.col(key).alias("_ring_key"),
        (F.octet_length(body).cast("long") + 1).alias("_ring_size"),
        F.crc32(body.cast("binary")).alias("_ring_crc"),
        F.xxhash64(F.lit(seed), F.lit("key"), F.col(key)).alias("_ring_at"),
        *(F.col(c).alias(f"_ring_keep_{i}") for i, c in enumerate(keep)),
    ).withColumn("_ring_cell", F.shiftright("_ring_at", shift))
    cells = literal_table(spark, pieces, "cell long, lo long, hi long, arc int")
    inside = (F.col("_ring_cell") == F.col("cell")) & F.col("_ring_at").between(F.col("lo"), F.col("hi"))
    rows = rows.join(F.broadcast(cells), inside).withColumn(
        "part", F.pmod(F.xxhash64("_ring_key", "_ring_crc", "_ring_size"), F.lit(parts)).cast("int")
    )
    rows = materialize(rows.drop("_ring_cell", "cell", "lo", "hi"), "ring")
    counts = {(r["arc"], r["part"]): r["n"] for r in rows.groupBy("arc", "part").agg(F.count("*").alias("n")).collect()}
    plan = place(ring, counts, capacities(sum(counts.values()), shards, load_factor))
    plan_table = literal_table(spark, plan, "arc int, part int, lo long, hi long, shard int, base long")
    order = Window.partitionBy("arc", "part").orderBy("_ring_at", "_ring_key", "_ring_crc", "_ring_size")
    ranked = rows.withColumn("_ring_rank", F.row_number().over(order).cast("long") - 1)
    ranked = ranked.join(F.broadcast(shard_of), "arc")
    here = (
        (ranked["arc"] == plan_table["arc"])
        & (ranked["part"] == plan_table["part"])
        & (F.col("_ring_rank") >= F.col("lo"))
        & (F.col("_ring_rank") < F.col("hi"))
    )
    return ranked.join(F.broadcast(plan_table), here).select(
        F.col("_ring_key").alias(key),
        F.col("_ring_size").alias("size"),
        F.col("_ring_crc").alias("text_crc32"),
        "shard",
        (F.col("base") + F.col("_ring_rank") - F.col("lo")).alias("slot"),
        "home",
        *(F.col(f"_ring_keep_{i}").alias(c) for i, c in enumerate(keep)),
    )


def null_int() -> Column:
    return F.lit(None).cast("int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards under the law ``rows``."""
    placed = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW_ROWS).alias("law"), "shard", "slot", null_int().alias("grown_shard"), "home"
    )
