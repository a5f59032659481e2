"""SparkSession settings the library relies on.

The pipeline is defined in UTC (event dates, partition paths, run dates), so
``ensure_conf`` pins the session time zone. Everything else only fills in a
setting when the cluster left it unset: a cluster's own shuffle sizing,
checkpoint folder and broadcast threshold always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied only where the session has no value of its own.
# (Write semantics - dynamic partition overwrite, zstd - are passed per
# write by the writers, so a caller's session is not changed for them.)
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def _unset(spark: SparkSession, key: str) -> bool:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some keys raise when unset
        value = None
    return value is None or value == ""


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Pin UTC and fill library defaults into an existing session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in DEFAULTS.items():
        if _unset(spark, key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used
    as is; without it a cluster has no place that all executors see, which is
    an error. Only a ``local`` master (tests) gets a scratch folder.
    """
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        conf_dir = tempfile.mkdtemp(prefix="propensia-ckpt-")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def build_session(app: str = "propensia", master: str | None = None, cpus: int | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own builder."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.appName(app)
        .master(master or f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # PySpark records the Python call site of every Column function for
        # error messages (several JVM round trips per call); plan building
        # is several times cheaper without it. Callers' sessions keep theirs.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    event_dir = os.environ.get("PROPENSIA_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings for offline reading (no UI server)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def materialize(df, label: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    One computation of the lineage (an eager ``checkpoint()`` computes an
    uncached plan twice: once to count, once to write), columnar read-back,
    and the copy survives executor loss. Files stay with the checkpoint
    folder, whose retention the cluster manages.
    """
    import uuid

    spark = df.sparkSession
    root = checkpoint_dir(spark).rstrip("/")
    path = f"{root}/propensia-{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def drop_copy(spark: SparkSession, path: str) -> None:
    """Delete a written copy that nothing reads any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(hadoop).delete(target, True)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per context).

    Spark serves the archive to the executors; where the package is installed
    on them already, this changes nothing.
    """
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_propensia_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="propensia-"), "propensia_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._propensia_shipped = True
