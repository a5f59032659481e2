"""Scalar functions of the pipeline as Spark ``Column`` expressions.

Each function takes and returns ``Column`` objects, so Catalyst folds them
into whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from propensia import schemas as S

__all__ = [
    "col_or_name",
    "currency_convert",
    "channel_clean",
    "transaction_type_clean",
    "merchant_category_group",
    "merchant_group_bit",
    "to_event_date",
    "engagement_segment",
    "campaign_segment",
    "sigmoid",
    "probability_decile",
    "expected_lift",
    "format_lift",
    "round_half_away",
    "try_date",
    "as_date_column",
    "hive_parts",
    "as_date_literal",
]


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_literal(d: _dt.date | str) -> Column:
    """A run date as a DATE literal (constant-folded, pushed to scans)."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def currency_convert(amount: Column | str, currency: Column | str) -> Column:
    """KES -> USD at the fixed rate, USD unchanged, anything else NULL."""
    amount, currency = col_or_name(amount), col_or_name(currency)
    return (
        F.when(currency == F.lit("KES"), amount / F.lit(S.KES_PER_USD))
        .when(currency == F.lit("USD"), amount.cast("double"))
        .otherwise(F.lit(None).cast("double"))
    )


def channel_clean(channel: Column | str) -> Column:
    c = F.lower(col_or_name(channel))
    return (
        F.when(c.isin(*S.DIGITAL_CHANNELS), "digital")
        .when(c == "branch", "branch")
        .when(c == "atm", "atm")
        .when(c == "agent", "agent")
        .otherwise("unknown")
    )


def transaction_type_clean(transaction_type: Column | str) -> Column:
    t = F.lower(col_or_name(transaction_type))
    return (
        F.when(t.isin(*S.PURCHASE_TYPES), "purchase")
        .when(t.isin(*S.TRANSFER_TYPES), "transfer")
        .when(t == "withdrawal", "withdrawal")
        .when(t == "deposit", "deposit")
        .when(t == "bill_pay", "bill_pay")
        .otherwise("other")
    )


def merchant_category_group(mcc: Column | str) -> Column:
    """Searched CASE over inclusive MCC ranges; NULL and unmatched -> other."""
    mcc = col_or_name(mcc)
    expr = None
    for name, lo, hi in S.MCC_RANGES:
        cond = mcc.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(S.MCC_OTHER)


def merchant_group_bit(group: Column | str) -> Column:
    """One bit per merchant group (the domain is closed: 5 values).

    OR-ing these bits over a frame and counting set bits gives the exact
    number of distinct groups, with a fixed-size int as window state.
    """
    if len(S.MERCHANT_GROUPS) > 31:  # the mask is an int; a wide domain needs another plan
        raise ValueError("merchant_group_bit supports at most 31 groups")
    g = col_or_name(group)
    expr = None
    for i, name in enumerate(S.MERCHANT_GROUPS):
        expr = F.when(g == name, F.lit(1 << i)) if expr is None else expr.when(g == name, F.lit(1 << i))
    return expr.otherwise(F.lit(0))


def to_event_date(ts: Column | str) -> Column:
    """``cast(timestamp as date)``; timestamps are NTZ, so zone-free."""
    return col_or_name(ts).cast("date")


def engagement_segment(txn_count_30d: Column | str, digital_ratio_30d: Column | str) -> Column:
    n, r = col_or_name(txn_count_30d), col_or_name(digital_ratio_30d)
    expr = None
    for min_count, min_ratio, name in S.ENGAGEMENT_RULES:
        cond = n >= min_count if min_ratio is None else (n >= min_count) & (r >= min_ratio)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(S.ENGAGEMENT_DEFAULT)


def campaign_segment(decile: Column | str) -> Column:
    d = col_or_name(decile)
    expr = None
    for min_decile, name in S.CAMPAIGN_RULES:
        expr = F.when(d >= min_decile, name) if expr is None else expr.when(d >= min_decile, name)
    return expr.otherwise(S.CAMPAIGN_DEFAULT)


def sigmoid(x: Column | str) -> Column:
    clipped = F.least(F.greatest(col_or_name(x).cast("double"), F.lit(-S.SIGMOID_CLIP)), F.lit(S.SIGMOID_CLIP))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def probability_decile(p: Column | str) -> Column:
    """Absolute decile of a probability: ``min(10, max(1, ceil(10 p)))``."""
    return F.least(F.lit(10), F.greatest(F.lit(1), F.ceil(col_or_name(p) * 10).cast("int")))


def expected_lift(p: Column | str, base_rate: float = S.BASE_ADOPTION_RATE) -> Column:
    if base_rate <= 0:
        return F.lit(0.0)
    return col_or_name(p) / F.lit(float(base_rate))


def format_lift(lift: Column | str) -> Column:
    """``'%.1fx'``. Java formatting rounds exact halves up (0.25 -> 0.3x)."""
    return F.format_string("%.1fx", col_or_name(lift))


def round_half_away(x: Column | str, places: int = 6, slack: float = 0.0) -> Column:
    """Round the binary value half away from zero: ``floor(|x| 10^p + 0.5)``.

    Unlike ``F.round`` (which rounds the shortest decimal text), this is
    the same IEEE arithmetic in any engine, so equal inputs give equal
    outputs. Exact for ``|x| 10^p < 2^52``. ``slack`` also rounds up what is
    that little below a half: sums that differ by their order only then agree.
    """
    c = col_or_name(x).cast("double")
    scale = float(10**places)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5 + slack)) / F.lit(scale)


def round_binary(x: Column | str, places: int) -> Column:
    """Round a non-negative double by its exact binary value, halves to even.

    ``t = floor(x 10^p)`` and the sign of ``x - (2t + 1) / (2 10^p)``, which
    comes out exactly: x is split into a 24-bit part and the rest, and both
    products with ``2 10^p`` fit a double.
    """
    c = col_or_name(x).cast("double")
    scale = float(10**places)
    t = F.floor(c * F.lit(scale)).cast("double")
    high = c.cast("float").cast("double")
    side = (high * F.lit(2 * scale) - (t * 2 + 1)) + (c - high) * F.lit(2 * scale)
    up = F.when(side > 0, 1.0).when((side == 0) & (t % 2 == 1), 1.0).otherwise(0.0)
    return (t + up) / F.lit(scale)


def try_date(c: Column | str) -> Column:
    """Tolerant date parse: invalid text or types become NULL."""
    return F.to_date(F.try_to_timestamp(col_or_name(c).cast("string")))


def as_date_column(df, name: str):
    """F15 on a frame: parse ``name`` tolerantly unless it already is a DATE."""
    from pyspark.sql import types as T

    if isinstance(df.schema[name].dataType, T.DateType):
        return df
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(name, F.col(name).cast("date"))
    return df.withColumn(name, try_date(name))


def hive_parts(d: Column | str) -> list[Column]:
    """Zero-padded ``year``, ``month``, ``day`` strings for partition paths."""
    d = col_or_name(d)
    return [
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
    ]
