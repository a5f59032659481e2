import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.sources import lake as IO
from propensia.sources.seed import read_seed_csv, seed_frame


def test_nanosecond_parquet(spark, scratch):
    path = os.path.join(scratch, "nanos.parquet")
    ts = pa.array([1_700_000_000_123_456_789], type=pa.timestamp("ns"))
    pq.write_table(pa.table({"t": ts, "k": ["a"]}), path)
    got = IO.read_nanos_parquet(spark, path, ["t"]).first()
    assert got.t == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == "false"


def test_run_partition_is_written_without_a_shuffle(spark, scratch):
    df = spark.range(1000, numPartitions=4).withColumn("x", F.col("id") % 7)
    root = os.path.join(scratch, "plain")
    IO.write_run_partition(df, root, "2024-08-03")
    assert len([f for f in spark.read.parquet(root).inputFiles()]) == 4  # a file a task: nothing was dealt anew
    assert IO.read_prefix(spark, root).count() == 1000


def test_other_read_errors_are_not_hidden(spark, scratch):
    from pyspark.errors import AnalysisException

    root = os.path.join(scratch, "clash")
    spark.range(1).write.parquet(os.path.join(root, "year=2024"))
    spark.range(1).write.parquet(os.path.join(root, "other=1", "more=2"))
    with pytest.raises(Exception) as error:
        IO.read_prefix(spark, root).collect()
    assert not isinstance(error.value, FileNotFoundError) and isinstance(error.value, (AnalysisException, Exception))


def test_partition_layout_and_scores_as_of(spark, scratch):
    df = spark.createDataFrame([("a", 0.5, 3, "NURTURE", dt.date(2024, 8, 2))], "customer_token string, "
                               "propensity_score double, score_decile int, campaign_segment string, feature_date date")
    root = os.path.join(scratch, "scores")
    IO.write_run_partition(df, root, "2024-08-03")
    IO.write_run_partition(df, root, "2024-08-10")
    assert os.path.isdir(os.path.join(root, "year=2024", "month=08", "day=03"))
    assert IO.read_scores(spark, root).count() == 2
    assert IO.read_scores(spark, root, as_of="2024-08-05").count() == 1
    # rerun of one partition replaces only that partition
    IO.write_run_partition(df.union(df), root, "2024-08-03")
    assert IO.read_scores(spark, root).count() == 3


def test_missing_prefix(spark, scratch):
    with pytest.raises(FileNotFoundError):
        IO.read_prefix(spark, os.path.join(scratch, "nothing-here"))


def test_merge_schema_union(spark, scratch):
    root = os.path.join(scratch, "mixed")
    spark.createDataFrame([(1,)], "a int").write.parquet(os.path.join(root, "year=2024", "month=1", "day=1"))
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(os.path.join(root, "year=2024", "month=1", "day=2"))
    got = sorted((r.a, r.b) for r in IO.read_prefix(spark, root, merge_schema=True).collect())
    assert got == [(1, None), (2, "x")]


def test_seed_csv(spark, scratch):
    path = os.path.join(scratch, "seed.csv")
    with open(path, "w") as fh:
        fh.write("merchant_mcc,merchant_category_group\n")
        fh.writelines(f"{c},{g}\n" for c, g in S.MCC_SEED)
    a = sorted(tuple(r) for r in read_seed_csv(spark, path).collect())
    b = sorted(tuple(r) for r in seed_frame(spark).collect())
    assert a == b and dict(read_seed_csv(spark, path).dtypes)["merchant_mcc"] == "int"


def test_raw_reader_schema(spark, scratch):
    root = os.path.join(scratch, "raw")
    IO.write_partitioned(spark.createDataFrame([], S.RAW_TRANSACTIONS), root, F.lit(dt.date(2024, 1, 1)))
    with pytest.raises(FileNotFoundError):  # a folder without a file is no input
        IO.read_raw_transactions(spark, root)
    row = spark.createDataFrame([[None] * len(S.RAW_TRANSACTIONS.fields)], S.RAW_TRANSACTIONS)
    IO.write_partitioned(row, root, F.lit(dt.date(2024, 1, 1)))
    df = IO.read_raw_transactions(spark, root)
    assert [f.name for f in S.RAW_TRANSACTIONS.fields] == df.columns[: len(S.RAW_TRANSACTIONS.fields)]
