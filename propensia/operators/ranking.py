"""Global order statistics without a single-partition window.

``Window.orderBy(...)`` with no partition key moves every row to one task.
Here the key space is cut into contiguous ranges instead:

1. split points on the full composite key ``(order keys...)`` are taken
   from a bounded, seeded sample (at most ``buckets * SAMPLE_PER_BUCKET``
   rows reach the driver), so a tied score that holds a third of all rows
   is still spread over many ranges by the tie-break columns;
2. each row gets its range id from a binary search over those points, held
   in one folded array literal (JVM-side; the generated code does not grow
   with the number of ranges);
3. per-range totals (one row per range) give exclusive offsets;
4. a window partitioned by range id computes the local running value and
   adds the offset.

All expressions are deterministic, so a lost executor recomputes the same
ranks. The number of ranges grows with the data (``rows_per_bucket`` rows
each, at any size) and is at least the cluster's parallelism, so small inputs
take the same distributed path as large ones.
"""

from __future__ import annotations

import datetime
import decimal
import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
SAMPLE_PER_BUCKET = 32
SEED = 42


def _plain(v):
    """A sampled value as JSON that ``from_json`` reads back exactly."""
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v) if isinstance(v, decimal.Decimal) else v


def _array_literal(values: list, element: str) -> Column:
    """A foldable array of ``element`` (DDL) values."""
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "allowNonNumericNumbers": "true"}
    return F.from_json(F.lit(json.dumps(values)), f"array<{element}>", options)


def _bucket_expr(df: DataFrame, keys: list[str], splits: list[tuple]) -> Column:
    """Range id = number of split points <= key, by binary search."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [f"k{i}" for i in range(len(keys))]
    key = F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    element = "struct<" + ",".join(f"{n}:{types[k]}" for k, n in zip(keys, names)) + ">"
    points = _array_literal([dict(zip(names, map(_plain, row))) for row in splits], element)
    steps = len(splits).bit_length() + 1
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi"))

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = ((lo + hi + 1) / 2).cast("int")
        go_left = key < F.element_at(points, mid)  # split `mid` opens id `mid`
        narrowed = F.when(go_left, F.struct(lo.alias("lo"), (mid - 1).alias("hi"))).otherwise(
            F.struct(mid.alias("lo"), hi.alias("hi"))
        )
        return F.when(lo >= hi, acc).otherwise(narrowed)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])


def _splits(df: DataFrame, keys: list[str], n: int, buckets: int) -> list[tuple]:
    fraction = min(1.0, buckets * SAMPLE_PER_BUCKET / max(n, 1))
    # The sample is bounded (about buckets * SAMPLE_PER_BUCKET rows): shuffle
    # it into one partition and sort there - one job, no range-sampling pass
    # of a global sort, and the scan itself stays parallel.
    picked = df.select(*keys).sample(False, fraction, SEED).repartition(1).sortWithinPartitions(*keys)
    sample = [tuple(r) for r in picked.collect()]
    if not sample:
        return []
    picks = []
    for i in range(1, buckets):
        row = sample[min(len(sample) - 1, i * len(sample) // buckets)]
        if not picks or row != picks[-1]:
            picks.append(row)
    return picks


def with_ranges(df: DataFrame, keys: list[str], n: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET):
    """Add ``_range`` (contiguous key ranges) and return (df, n, ranges)."""
    if n is None:
        n = df.count()
    # rows_per_bucket rows each; small inputs use the whole cluster as well
    parallel = min(df.sparkSession.sparkContext.defaultParallelism, n)
    buckets = max(1, math.ceil(n / rows_per_bucket), parallel)
    splits = _splits(df, keys, n, buckets) if buckets > 1 else []
    rid = _bucket_expr(df, keys, splits) if splits else F.lit(0)
    return df.withColumn("_range", rid), n, len(splits) + 1


def prefix_sums(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column],
    inclusive: bool = True,
    n: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    materialize: bool = True,
) -> DataFrame:
    """Running sums of ``sums`` in ascending ``keys`` order (NULLs first).

    Rows with equal full keys are ordered arbitrarily among themselves, so
    pass keys that are unique per row when that matters. The range path
    reads its input up to four times (count, sample, totals, final); with
    ``materialize`` the input is written once to the checkpoint folder and
    those passes read that copy instead of recomputing the upstream plan
    (a scoring model, joins, windows). Pass ``False`` for cheap inputs.
    """
    base = df.select("*", *[c.alias(f"_v_{name}") for name, c in sums.items()])
    if materialize:
        from propensia.session import materialize as _materialize

        base = _materialize(base, "ranking")
    ranged, n, ranges = with_ranges(base, keys, n, rows_per_bucket)
    if ranges > 1:
        per_range = ranged.groupBy("_range").agg(*[F.sum(f"_v_{k}").alias(k) for k in sums]).collect()
        totals = {r["_range"]: r for r in per_range}
    else:
        totals = {}  # one range: every offset is 0, no pass needed
    offsets = {}
    for name in sums:
        run, acc = [], 0
        for i in range(ranges):
            run.append(acc)
            v = totals[i][name] if i in totals else None
            acc += v or 0
        offsets[name] = run
    frame = Window.partitionBy("_range").orderBy(*keys)
    frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    cols = []
    for name in sums:
        local = F.coalesce(F.sum(f"_v_{name}").over(frame), F.lit(0))
        offset_arr = _array_literal(offsets[name], "double" if any(isinstance(v, float) for v in offsets[name]) else "bigint")
        cols.append((local + F.element_at(offset_arr, F.col("_range") + 1)).alias(name))
    return ranged.select(*df.columns, *cols)


def global_rank(
    df: DataFrame,
    keys: list[str],
    rank_col: str = "rank",
    n: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    materialize: bool = True,
):
    """1-based row number in ascending ``keys`` order; returns (df, n)."""
    if materialize:
        from propensia.session import materialize as _materialize

        df = _materialize(df, "ranking")
    if n is None:
        n = df.count()
    if n == 0:
        return df.withColumn(rank_col, F.lit(None).cast("long")), 0
    ranked = prefix_sums(df, keys, {rank_col: F.lit(1).cast("long")}, n=n, rows_per_bucket=rows_per_bucket, materialize=False)
    return ranked, n


def decile_from_rank(rank: Column | str, n: int) -> Column:
    """Quantile cut of ranks 1..n into 10 equal-width rank bins.

    n >= 10: ``max(1, ceil(10 (r-1) / (n-1)))``; n < 10: ``ceil(10 r / n)``;
    integer arithmetic only.
    """
    r = F.col(rank) if isinstance(rank, str) else rank
    if n >= 10:
        return F.greatest(F.lit(1), ((F.lit(10) * (r - 1) + (n - 2)) / F.lit(n - 1)).cast("long")).cast("int")
    return ((F.lit(10) * r + (n - 1)) / F.lit(n)).cast("long").cast("int")


def assign_deciles(
    df: DataFrame,
    score_col: str,
    tiebreak: list[str],
    out: str = "score_decile",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    materialize: bool = True,
) -> DataFrame:
    """W5 + W7: rank by (score, tie-break) ascending, decile 10 = highest."""
    ranked, n = global_rank(df, [score_col, *tiebreak], "_score_rank", rows_per_bucket=rows_per_bucket, materialize=materialize)
    if n == 0:
        return df.withColumn(out, F.lit(None).cast("int"))
    return ranked.withColumn(out, decile_from_rank("_score_rank", n)).drop("_score_rank")


def top_count(n: int, fraction: float = 0.10) -> int:
    """``max(1, ceil(fraction * n))`` in double arithmetic (n=30 -> 4)."""
    return max(1, int(math.ceil(float(fraction) * n))) if n else 0
