"""W1 + A3: rolling sums over rows and distinct counts over days, for keys of any size.

A window partitioned by a key sorts all rows of that key in one task. Here a
key that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensia.operators.ranking import global_rank

ROWS_PER_BLOCK = 500_000


def rolling_sql(column: str, spec: str, n: int) -> str:
    """The sum of ``column`` over the last ``n`` rows of a window spec, as SQL."""
    return f"sum({column}) OVER ({spec} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling_window(df: DataFrame, sums: dict[str, tuple[str, int]], by: list[str], order: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``df`` with sums over the last n rows of each key, ``sums`` = {new column: (column, n)}.

    All rows get a dense number in (by, order) sequence (``ranking``, without a
    single-task window) and are cut into blocks of that sequence, whatever the
    keys. A block is also given the n - 1 rows before it, for the greatest n,
    and a window partitioned by (block, key) does the rest: one exchange, and
    no task with more than a block and its halo.

    Nulls: a null key is a key of its own; null order values come last; null
    values add nothing, a frame of nulls only gives null. Rows equal in
    ``by`` and ``order`` follow each other in any order, so end ``order`` with
    a unique column. Empty table: no rows.
    """
    halo = max(n for _, n in sums.values()) - 1
    if min(n for _, n in sums.values()) < 1:
        raise ValueError("a window needs at least one row")
    late = {c: f"_null_{i}" for i, c in enumerate(order)}
    rows = df.select("*", *(F.col(c).isNull().alias(flag) for c, flag in late.items()))
    keys = [*by, *(k for c in order for k in (late[c], c))]
    ranked, n = global_rank(rows, keys, "_at")
    if n == 0:
        return df.select("*", *(F.lit(None).cast(_sum_type(df, c)).alias(name) for name, (c, _) in sums.items()))
    # Small inputs are cut as well, so that they take the same path.
    parallel = df.sparkSession.sparkContext.defaultParallelism
    size = max(halo, 1, min(rows_per_block, math.ceil(n / parallel)))
    at = F.col("_at") - 1
    block = F.floor(at / size).cast("long")
    copies = F.array(F.struct(block.alias("block"), F.lit(False).alias("halo")))
    if halo:
        ahead = F.struct((block + 1).alias("block"), F.lit(True).alias("halo"))
        copies = F.when(at % size >= size - halo, F.concat(copies, F.array(ahead))).otherwise(copies)
    dealt = ranked.withColumn("_copy", F.explode(copies))
    frame = Window.partitionBy("_copy.block", *by).orderBy("_at")
    added = [F.sum(c).over(frame.rowsBetween(1 - length, 0)).alias(name) for name, (c, length) in sums.items()]
    return dealt.select(*df.columns, "_copy", *added).filter("not _copy.halo").drop("_copy")


def _sum_type(df: DataFrame, column: str) -> str:
    return df.select(F.sum(column).alias("s")).schema["s"].dataType.simpleString()


def sliding_distinct(rows: DataFrame, by: str, day: str, value: str, days: int, out: str = "distinct_values") -> DataFrame:
    """A3: for every (by, day) in ``rows``, the number of distinct values in the ``days`` calendar days up to it.

    Exact for any number of values. Rows shrink to distinct (key, value, day)
    first, with map-side combine. An occurrence counts from its day until it
    leaves the window or the same value occurs again, whichever is first, so
    the spans of a value don't overlap: each adds 1 where it begins and takes
    1 where it ends, and the count is a running sum. Work is linear in distinct
    occurrences; a key's window holds at most two rows a calendar day.

    Null values aren't counted. Rows with a null key or day get 0.
    """
    if days < 1:
        raise ValueError("a window needs at least one day")
    at = F.unix_date(F.col(day).cast("date"))
    narrow = rows.select(F.col(by).alias("_by"), at.alias("_at"), F.col(value).alias("_value"))
    known = narrow.filter(F.col("_by").isNotNull() & F.col("_at").isNotNull())
    seen = known.filter(F.col("_value").isNotNull()).groupBy("_by", "_value").agg(F.sort_array(F.collect_set("_at")).alias("_days"))

    def span(d: Column, i: Column) -> Column:
        following = F.get("_days", i + 1)
        end = F.least(d + F.lit(days), F.coalesce(following, d + F.lit(days)))
        return F.array(F.struct(d.alias("at"), F.lit(1).alias("step")), F.struct(end.alias("at"), F.lit(-1).alias("step")))

    steps = seen.select("_by", F.inline(F.flatten(F.transform("_days", span)))).select("_by", F.col("at").alias("_at"), "step", F.lit(False).alias("_here"))
    present = known.select("_by", "_at", F.lit(0).alias("step"), F.lit(True).alias("_here"))
    by_day = steps.unionByName(present).groupBy("_by", "_at").agg(F.sum("step").alias("step"), F.max("_here").alias("_here"))
    running = F.sum("step").over(Window.partitionBy("_by").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    counted = by_day.select("_by", "_at", running.alias("n"), "_here").filter("_here")
    unknown = narrow.filter(F.col("_by").isNull() | F.col("_at").isNull()).select("_by", "_at").distinct()
    found = counted.select("_by", "_at", "n").unionByName(unknown.select("_by", "_at", F.lit(0).cast("long").alias("n")))
    return found.select(F.col("_by").alias(by), F.date_from_unix_date("_at").alias(day), F.col("n").alias(out))
