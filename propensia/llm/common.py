"""Helpers shared by the corpus operators: small literal tables, written
copies that cut lineage, deletion of copies that are no longer read."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.session import checkpoint_dir, drop_copy, materialize, ship

__all__ = ["checkpoint_dir", "materialize", "literal_table", "drop_copy", "scratch_path", "fill", "hold_out", "release", "ship", "unused"]

#: Words of every text operator here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def literal_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A small table as one JSON literal (JVM only, broadcastable).

    Callers pass rows whose number is bounded by a parameter, never by data.
    ``schema`` is a struct's DDL such as ``arc int, lo long``.
    """
    text = json.dumps(list(rows), separators=(",", ":"))
    typed = F.from_json(F.lit(text), f"array<struct<{','.join(_ddl(schema))}>>")
    return spark.range(1, numPartitions=1).select(F.inline(typed))


def _ddl(schema: str) -> Iterable[str]:
    for field in schema.split(","):
        name, kind = field.split()
        yield f"{name}:{'bigint' if kind == 'long' else kind}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/propensia-{label}-{uuid.uuid4().hex}"


def fill(text: str):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hold_out(key: str, modulus: int):
    """crc32 of the key's decimal text modulo ``modulus`` (null key: of no bytes)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer used: it
    does so once the driver has collected these, which small drivers' work seldom
    makes it do."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
