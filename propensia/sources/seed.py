"""Merchant category seed (a 20-row dimension; broadcast is size-proven)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensia import schemas as S


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a seed CSV with a typed integer ``merchant_mcc``."""
    return spark.read.option("header", True).schema(S.SEED_SCHEMA).csv(path)


def seed_frame(spark: SparkSession) -> DataFrame:
    """The seed as a DataFrame built from the fixed values."""
    return spark.createDataFrame(S.MCC_SEED, S.SEED_SCHEMA)
