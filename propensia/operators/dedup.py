"""Keep-last deduplication as an aggregate, not a per-key window.

``max(struct(order..., payload...))`` per key is a hash aggregate with a
map-side partial step, so a key holding a large share of the rows is
collapsed on every map task before the shuffle (a ``row_number`` window
would send all of that key's rows to one task). Ties on the order key are
broken by the payload, which makes the result deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensia.sources.lake import PARTITION_COLUMNS, POSITION_COLUMNS


def keep_last(df: DataFrame, keys: list[str], order_by: list[str], nulls_last: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``order_by`` values.

    The whole row travels through the aggregate, so select the columns that
    are needed first. A null order value counts as the smallest, in the
    columns of ``nulls_last`` as the greatest.
    """
    payload = [c for c in df.columns if c not in keys]
    ordered = list(order_by) + [c for c in payload if c not in order_by]
    fields = []
    for c in ordered:
        if c in nulls_last:
            fields.append(F.col(c).isNull().alias(f"_null_{c}"))
        fields.append(F.col(c))
    out = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_last"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def file_order(df: DataFrame) -> list[str]:
    """Order key standing for "later file": run-date partition, then the place of
    the row (path of its file, number in it) where the read gave it."""
    return [c for c in [*PARTITION_COLUMNS, *POSITION_COLUMNS] if c in df.columns]


def latest_labels(labels: DataFrame) -> DataFrame:
    """Labels: last by ``_ingestion_date`` (undated rows last of all, then run
    partition) per token; only these columns are read."""
    dated = ["_ingestion_date"] if "_ingestion_date" in labels.columns else []
    order = dated + file_order(labels)
    needed = labels.select("customer_token", "adopted_card", *order)
    return keep_last(needed, ["customer_token"], order, tuple(dated)).select("customer_token", "adopted_card")


def latest_feature_rows(features: DataFrame) -> DataFrame:
    """Feature history: last version of each (token, feature_date)."""
    return keep_last(features, ["customer_token", "feature_date"], file_order(features))
