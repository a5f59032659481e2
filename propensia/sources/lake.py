"""Lake readers and writers (Hive ``year=/month=/day=`` layout, zstd Parquet).

Readers take explicit schemas at the raw boundary and keep the partition
columns, so date filters on them prune directories and later keep-last
dedups can order by them. Writers use dynamic partition overwrite: a rerun
replaces exactly the partitions it produces and nothing else.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions.expr import as_date_literal, hive_parts

PARTITION_COLUMNS = ["year", "month", "day"]


# ---------------------------------------------------------------- readers --
def read_raw_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Tokenised transactions under ``root/year=*/month=*/day=*``."""
    return _read(spark, root, S.RAW_TRANSACTIONS)


def read_raw_labels(spark: SparkSession, root: str, positions: bool = False) -> DataFrame:
    """Customer labels, partitioned by run date."""
    labels = _read(spark, root, S.RAW_LABELS)
    return with_positions(labels) if positions else labels


#: Where a row stands: the path of its file and its number in it.
POSITION_COLUMNS = ["_file", "_row"]


def with_positions(scan: DataFrame) -> DataFrame:
    """A Parquet scan with the position of every row (``POSITION_COLUMNS``)."""
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def read_scores(spark: SparkSession, root: str, as_of: _dt.date | str | None = None) -> DataFrame:
    """S3: every published weekly score partition (optionally up to ``as_of``)."""
    df = read_prefix(spark, root)
    if as_of is not None:
        df = df.filter(partition_date() <= as_date_literal(as_of))
    return df


def read_prefix(spark: SparkSession, path: str, merge_schema: bool = False, positions: bool = False) -> DataFrame:
    """S4 + T4: one multi-file scan of every Parquet file under a prefix.

    Partition columns are kept; ``positions`` adds the place of every row, by
    which keep-last takes the later file's. ``merge_schema`` unions files whose column
    sets differ (missing columns read as NULL). An absent or empty prefix
    raises ``FileNotFoundError`` before any job runs; any other problem
    (conflicting schemas or partitions) keeps Spark's own error.
    """
    require_files(spark, path)
    rows = spark.read.option("basePath", path).option("mergeSchema", str(merge_schema).lower()).parquet(path)
    return with_positions(rows) if positions else rows


def require_files(spark: SparkSession, path: str) -> None:
    """Raise unless some Parquet file lies below ``path`` (stops at the first)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(target):
        files = store.listFiles(target, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                return
    raise FileNotFoundError(f"{path}: no Parquet file in this folder or below it")


def _read(spark: SparkSession, root: str, schema) -> DataFrame:
    require_files(spark, root)
    return spark.read.schema(schema).option("basePath", root).parquet(root)


def read_nanos_parquet(spark: SparkSession, path: str, timestamp_columns: list[str]) -> DataFrame:
    """Read files whose timestamps are Parquet ``TIMESTAMP(NANOS)``.

    Spark refuses that type by default. A session of its own reads the
    values as longs (``spark.sql.legacy.parquet.nanosAsLong``), turns them
    into microsecond NTZ timestamps and writes that copy to the shared
    folder, so the caller's session and its other reads stay as they are.
    """
    from propensia.session import materialize

    require_files(spark, path)
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = own.read.parquet(path)
    for c in timestamp_columns:
        micros = F.expr(f"(`{c}` - pmod(`{c}`, 1000)) div 1000")  # exact floor, no doubles
        df = df.withColumn(c, F.timestamp_micros(micros).cast("timestamp_ntz"))
    written = materialize(df, "nanos").inputFiles()
    return spark.read.parquet(written[0].rsplit("/", 1)[0]) if written else spark.createDataFrame([], df.schema)


def read_live(spark: SparkSession, root: str, log: str, schema, batch: str | None = None) -> DataFrame:
    """Rows of the committed writes of a batched table (``merge_write``), partition columns kept.

    The names of the writes (one a batch) prune the folders to open; the log,
    a row per (date, write), then tells which of a write's dates still count.
    Dead and unfinished writes are never opened. ``batch`` keeps that batch's rows: of its own writes and of
    compacted ones, which hold rows of several batches.
    """
    live = live_writes(spark, log)
    rows = _read(spark, root, schema)
    if batch is not None:
        live = live.filter((F.col("batch") == batch) | F.col("batch").isNull())
        rows = rows.filter(F.col("_batch_id") == batch)
    names = [r["write"] for r in live.select("write").distinct().collect()]
    rows = rows.filter(F.col("write").isin(names))
    kept = live.select(F.col("write").alias("_w"), F.col("event_date").alias("_d"))
    found = (F.col("write") == F.col("_w")) & partition_date().eqNullSafe(F.col("_d"))
    return rows.join(kept, found, "left_semi")


def live_writes(spark: SparkSession, log: str) -> DataFrame:
    """(event_date, batch, write) that are committed and not replaced; batch is null for compacted ones."""
    entries = _read(spark, log, LOG_SCHEMA)
    by_write = entries.groupBy("event_date", "write").agg(F.max("batch").alias("batch"), F.max("replaced").alias("replaced"))
    return by_write.filter("not replaced").select("event_date", "batch", "write")


def partition_date() -> "F.Column":
    """The date named by the ``year/month/day`` partition columns."""
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


# ---------------------------------------------------------------- writers --
def with_hive_parts(df: DataFrame, date_col) -> DataFrame:
    """Add zero-padded string ``year/month/day`` (paths stay ``month=08``)."""
    return df.select("*", *hive_parts(date_col))


def write_partitioned(df: DataFrame, root: str, date_col, mode: str = "overwrite") -> None:
    """One partition per date of ``date_col``; rerun-safe (dynamic overwrite).

    The ``rebalance`` hint lets AQE cut the write into advisory-sized tasks
    per date: a date holding a third of the batch is split across many
    tasks and files, while small dates are coalesced (no file per task per
    date explosion).
    """
    _write(with_hive_parts(df, date_col).hint("rebalance", *PARTITION_COLUMNS), root, mode)


def _write(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(root)
    )


#: The commit log of a batched table: one small file a commit, only ever appended to.
LOG_SCHEMA = "event_date date, batch string, write string, replaced boolean"


def merge_write(df: DataFrame, root: str, log: str, date_col, batch: str | None, replaces: DataFrame | None = None) -> str:
    """Add a batch to a table partitioned by event date without touching other batches.

    Every write gets sub-partitions of its own, ``year=/month=/day=/write=``,
    and counts from the moment its dates stand in the log. So an event that
    arrives late for a date joins the rows that are there, a write that dies
    half way is never seen, and a rerun of ``batch`` takes the place of that
    batch's earlier writes alone, dates it no longer has included.
    ``replaces`` names other (event_date, write) pairs to take the place of
    (compaction). One job at a time may write a batch; batches may be written
    at the same time. Returns the name of the write.
    """
    import uuid

    from propensia.session import materialize

    spark = df.sparkSession
    write = f"{batch or 'compacted'}-{uuid.uuid4().hex[:12]}"
    dated = with_hive_parts(df, date_col).drop("_event_date").withColumn("write", F.lit(write))
    out = dated.hint("rebalance", *PARTITION_COLUMNS).write.mode("append").option("compression", "zstd")
    out.partitionBy(*PARTITION_COLUMNS, "write").parquet(root)
    if replaces is None:
        try:
            replaces = live_writes(spark, log).filter(F.col("batch") == batch).select("event_date", "write")
        except FileNotFoundError:  # the first commit
            replaces = spark.createDataFrame([], "event_date date, write string")
    written = spark.createDataFrame([(d,) for d in _written_dates(spark, root, write)], "event_date date")
    added = written.select("event_date", F.lit(batch).cast("string").alias("batch"), F.lit(write).alias("write"), F.lit(False).alias("replaced"))
    gone = replaces.select("event_date", F.lit(batch).cast("string").alias("batch"), "write", F.lit(True).alias("replaced"))
    # Computed first: the log is read here and appended to next, by one task and so at once.
    commit = materialize(added.unionByName(gone), "commit")
    commit.coalesce(1).write.mode("append").parquet(log)
    return write


def _written_dates(spark: SparkSession, root: str, write: str) -> list[_dt.date | None]:
    """The dates of a write, from the names of its folders."""
    found = spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *(f"{c}=*" for c in PARTITION_COLUMNS), f"write={write}"]))
    dates = []
    for status in found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found):
        values = [part.split("=", 1)[1] for part in status.getPath().toString().split("/")[-4:-1]]
        dates.append(_dt.date(*map(int, values)) if all(v.isdigit() for v in values) else None)
    return dates


def compact(spark: SparkSession, root: str, log: str, schema, key: str, order: list[str], dates: list[_dt.date] | None = None) -> str | None:
    """Merge the writes of every date that has several (of ``dates``, if given) into one.

    Of the rows of a date with equal ``key`` the last by ``order`` stays; rows
    without a key all stay. Only such dates are read and rewritten. Returns the
    name of the write, None if there was nothing to merge.
    """
    from propensia.operators.dedup import keep_last
    from propensia.session import materialize

    live = live_writes(spark, log)
    if dates is not None:
        live = live.filter(F.col("event_date").isin(*[as_date_literal(d) for d in dates]))
    several = live.groupBy("event_date").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("event_date").alias("d"))
    merged = materialize(live.join(several, F.col("event_date").eqNullSafe(F.col("d"))).select("event_date", "write"), "merged")
    if merged.isEmpty():
        return None
    pairs = merged.select(F.col("write").alias("_w"), F.col("event_date").alias("_d"))
    rows = _read(spark, root, schema).join(pairs, (F.col("write") == F.col("_w")) & partition_date().eqNullSafe(F.col("_d")), "left_semi")
    rows = rows.withColumn("_event_date", partition_date()).drop(*PARTITION_COLUMNS, "write")
    last = keep_last(rows.filter(F.col(key).isNotNull()), [key, "_event_date"], order).unionByName(rows.filter(F.col(key).isNull()))
    day = materialize(last, "compacted")
    return merge_write(day, root, log, F.col("_event_date"), None, merged)


def sweep(spark: SparkSession, root: str, log: str) -> int:
    """Delete the folders of replaced writes; returns how many. Run it when no reader of the older state is left."""
    dead = _read(spark, log, LOG_SCHEMA).filter("replaced").select("event_date", "write").distinct().collect()  # a row a folder
    store, gone = None, 0
    for r in dead:
        d = r["event_date"]
        names = ["__HIVE_DEFAULT_PARTITION__"] * 3 if d is None else [f"{d:%Y}", f"{d:%m}", f"{d:%d}"]
        parts = [f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, names)]
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *parts, f"write={r['write']}"]))
        store = store or folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone += bool(store.delete(folder, True))
    return gone


def write_run_partition(df: DataFrame, root: str, run_date: _dt.date | str) -> None:
    """The whole frame under the run date's partition.

    All rows have the same partition, so they are not dealt by it: the tasks
    that made them write them, and no shuffle is added.
    """
    _write(with_hive_parts(df, as_date_literal(run_date)), root)


def write_metrics(df: DataFrame, root: str, run_date: _dt.date | str) -> str:
    """Add one run's metric row(s) to the history of the runs.

    Nothing is ever replaced: each call writes a folder of its own,
    ``year=/month=/day=/write=``, as one file by a job of its own, so it is seen
    whole or not at all, and runs, also of the same date, may record at the same
    time. ``recorded_at`` is set here. Returns the name of the write.
    """
    import uuid

    write, d = uuid.uuid4().hex, run_date if isinstance(run_date, _dt.date) else _dt.date.fromisoformat(run_date)
    folder = f"{root.rstrip('/')}/year={d:%Y}/month={d:%m}/day={d:%d}/write={write}"
    rows = df.withColumn("recorded_at", F.current_timestamp()).coalesce(1)
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(folder)
    return write


def read_metrics(spark: SparkSession, root: str, latest: bool = False) -> DataFrame:
    """The history of metric rows, with ``run_date`` and their ``version`` within it.

    Versions of a run date count its writes from 1 in the order of
    ``recorded_at`` (ties: by the write's name). ``latest`` keeps the last
    version of every run date. Rows whose columns differ are united.
    """
    run = Window.partitionBy("run_date")
    rows = read_prefix(spark, root, merge_schema=True).withColumn("run_date", partition_date()).drop(*PARTITION_COLUMNS)
    rows = rows.withColumn("version", F.dense_rank().over(run.orderBy("recorded_at", "write")))
    if latest:
        rows = rows.withColumn("_last", F.max("version").over(run)).filter("version = _last").drop("_last")
    return rows.drop("write")


def save_model(model, path: str) -> None:
    """Persist a fitted model (overwrite a run-dated path)."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(SparkSession.active(), path)


def load_model(path: str):
    """Load a fitted model, the library's own or a ``PipelineModel``, and check its feature contract."""
    from propensia.operators.boosting import PropensityModel

    spark = SparkSession.active()
    metadata = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/metadata")
    if metadata.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(metadata):
        from pyspark.ml import PipelineModel

        model = PipelineModel.load(path)
    else:
        model = PropensityModel.load(spark, path)
    model_features(model)
    return model


def model_features(model) -> list[str]:
    """Feature list of a fitted model (of a ``PipelineModel``: its ``VectorAssembler`` input columns)."""
    if hasattr(model, "feature_columns"):
        return list(model.feature_columns)
    from pyspark.ml.feature import VectorAssembler

    for stage in getattr(model, "stages", []):
        if isinstance(stage, VectorAssembler):
            cols = stage.getInputCols()
            if not cols or not all(isinstance(c, str) for c in cols):
                raise ValueError("The model names no feature columns.")
            return list(cols)
    raise ValueError("The model has no vector assembler, so its features are unknown.")
