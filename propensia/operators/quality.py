"""Q1-Q8: data tests as one report DataFrame and a gate.

All checks of a table take ONE scan and ONE shuffle. A row is expanded to an
entry with its row-level failures (not_null, positive, accepted_range,
no_future_peeking), one for each uniqueness check, and one for each list of
accepted values that it violates; entries are counted by (check, key), where a
key travels as two 64-bit hashes, 16 bytes whatever its columns. The entries
with row-level failures have one key and shrink to a row a task before the
shuffle, as repeated keys do. Failure counts follow the usual test semantics:
rows for row checks, duplicated keys for uniqueness, distinct offending values
for accepted_values. Two keys of n pass for one with a chance of n^2 / 2^129
(1e-15 for 1e12 keys).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensia.functions.expr import as_date_literal


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    params: tuple = field(default=())

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def not_null(c: str) -> Check:
    return Check("not_null", (c,))


def unique(c: str) -> Check:
    return Check("unique", (c,))


def positive(c: str) -> Check:
    return Check("positive", (c,))


def accepted_values(c: str, values) -> Check:
    return Check("accepted_values", (c,), tuple(values))


def accepted_range(c: str, min_value, max_value) -> Check:
    return Check("accepted_range", (c,), (min_value, max_value))


def unique_combination(*cols: str) -> Check:
    return Check("unique_combination", tuple(cols))


def no_future_peeking(c: str, as_of: _dt.date | str) -> Check:
    """Rows dated after the last complete day before ``as_of``."""
    return Check("no_future_peeking", (c,), (as_of,))


def _row_failure(check: Check):
    """Whether a row fails a row-level check (null: it doesn't)."""
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "positive":
        return c.isNull() | (c <= 0)
    if check.kind == "accepted_range":
        lo, hi = check.params
        return c.isNotNull() & ((c < lo) | (c > hi))
    if check.kind == "no_future_peeking":
        return c > F.date_sub(as_date_literal(check.params[0]), 1)
    raise ValueError(f"not a row check: {check.kind}")


GROUPED = ("unique", "unique_combination", "accepted_values")


def _entry(number: int, check: Check):
    """The key that a row adds to a grouped check; null if it adds none."""
    cols = [F.col(c) for c in check.columns]
    # Hashes pass over nulls, so which columns are null is hashed as well.
    flagged = [x for c in cols for x in (c, c.isNull())]
    key = F.struct(F.lit(number).alias("check"), F.xxhash64(*flagged).alias("a"), F.xxhash64(F.lit(1), *flagged).alias("b"))
    if check.kind == "accepted_values":
        return F.when(~cols[0].isin(*check.params), key)
    return F.when(cols[0].isNotNull(), key) if check.kind == "unique" else key


def quality_report(df: DataFrame, checks: list[Check], model: str) -> DataFrame:
    """(model, check, column, failures) for every check, lazily."""
    row_checks = [c for c in checks if c.kind not in GROUPED]
    key_checks = [c for c in checks if c.kind in GROUPED]
    fails = [F.coalesce(_row_failure(c), F.lit(False)).alias(f"f{i}") for i, c in enumerate(row_checks)]
    rows = F.struct(F.lit(-1).alias("check"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    entries = F.array_compact(F.array(*([rows] if row_checks else []), *(_entry(i, c) for i, c in enumerate(key_checks))))
    expanded = df.select(*fails, F.explode(entries).alias("e")).select("e.check", "e.a", "e.b", *(f"f{i}" for i in range(len(row_checks))))
    own = F.col("check") == -1
    counted = expanded.groupBy("check", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(own & F.col(f"f{i}")).alias(f"f{i}") for i in range(len(row_checks)))
    )
    totals = [F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(row_checks))]
    for i, c in enumerate(key_checks):
        this = F.col("check") == i
        totals.append(F.count_if(this if c.kind == "accepted_values" else this & (F.col("n") > 1)).alias(f"k{i}"))
    places = {id(c): f"c{i}" for i, c in enumerate(row_checks)} | {id(c): f"k{i}" for i, c in enumerate(key_checks)}
    ordered = [*row_checks, *key_checks]
    stacked = F.stack(F.lit(len(ordered)), *[x for c in ordered for x in (F.lit(c.kind), F.lit(c.column), F.col(places[id(c)]))])
    return counted.agg(*totals).select(F.lit(model).alias("model"), stacked.alias("check", "column", "failures"))


class QualityGateError(RuntimeError):
    pass


def assert_passing(report: DataFrame | list) -> None:
    """Q8: stop dependent stages when any check fails (a row per check)."""
    rows = report.collect() if isinstance(report, DataFrame) else report
    failing = [r for r in rows if r["failures"] > 0]
    if failing:
        lines = ", ".join(f"{r['model']}.{r['column']} {r['check']}={r['failures']}" for r in failing)
        raise QualityGateError(f"Data tests failed: {lines}")


# Test suites per layer (as declared for the warehouse models).
def bronze_checks() -> list[Check]:
    return [not_null("customer_token"), not_null("transaction_id"), unique("transaction_id"), not_null("amount"), positive("amount")]


def silver_checks() -> list[Check]:
    from propensia import schemas as S

    return [
        not_null("customer_token"),
        not_null("transaction_id"),
        unique("transaction_id"),
        accepted_values("channel_clean", S.CHANNEL_VALUES),
        accepted_values("transaction_type_clean", S.TRANSACTION_TYPE_VALUES),
        positive("amount_usd"),
    ]


def gold_checks(as_of=None) -> list[Check]:
    checks = [
        unique_combination("customer_token", "feature_date"),
        not_null("customer_token"),
        not_null("feature_date"),
        accepted_range("digital_ratio_30d", 0, 1),
    ]
    if as_of is not None:
        checks.append(no_future_peeking("feature_date", as_of))
    return checks


def features_checks() -> list[Check]:
    from propensia import schemas as S

    return [not_null("customer_token"), unique("customer_token"), accepted_values("engagement_segment", S.ENGAGEMENT_VALUES)]


def mart_checks() -> list[Check]:
    from propensia import schemas as S

    return [
        not_null("customer_token"),
        unique("customer_token"),
        accepted_range("propensity_score", 0, 1),
        accepted_values("campaign_segment", S.CAMPAIGN_VALUES),
    ]


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return repr(v)


def quality_sql(table: str, checks: list[Check], model: str) -> str:
    """The same report in plain SQL (used as the DuckDB oracle)."""
    parts = []
    for c in checks:
        col = c.columns[0]
        head = f"SELECT '{model}' AS model, '{c.kind}' AS \"check\", '{c.column}' AS \"column\", CAST("
        if c.kind == "not_null":
            body = f"count(*) FILTER (WHERE {col} IS NULL)) AS failures FROM {table}"
        elif c.kind == "positive":
            body = f"count(*) FILTER (WHERE {col} IS NULL OR {col} <= 0)) AS failures FROM {table}"
        elif c.kind == "accepted_range":
            lo, hi = c.params
            body = f"count(*) FILTER (WHERE {col} IS NOT NULL AND ({col} < {lo!r} OR {col} > {hi!r}))) AS failures FROM {table}"
        elif c.kind == "accepted_values":
            vals = ", ".join(_sql_lit(v) for v in c.params)
            body = f"count(DISTINCT CASE WHEN {col} NOT IN ({vals}) THEN {col} END)) AS failures FROM {table}"
        elif c.kind == "no_future_peeking":
            body = f"count(*) FILTER (WHERE {col} > {_sql_lit(_as_date(c.params[0]))} - INTERVAL 1 DAY)) AS failures FROM {table}"
        elif c.kind == "unique":
            body = f"count(*)) AS failures FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
        elif c.kind == "unique_combination":
            cols = ", ".join(c.columns)
            body = f"count(*)) AS failures FROM (SELECT {cols} FROM {table} GROUP BY {cols} HAVING count(*) > 1)"
        else:
            raise ValueError(c.kind)
        parts.append(head + body.replace(") AS failures", " AS BIGINT) AS failures", 1))
    return "\nUNION ALL\n".join(parts)


def _as_date(d):
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d
