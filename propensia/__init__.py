"""Spark-native customer propensity features, scoring and data-quality gates.

Every stage is a function ``DataFrame -> DataFrame`` (lazy); jobs in
``propensia.plans.jobs`` chain them and write partitioned Parquet.
"""

__version__ = "0.1.0"
