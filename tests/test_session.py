import os

from propensia.session import checkpoint_dir, ensure_conf, materialize


def test_ensure_conf_keeps_caller_settings(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ensure_conf(spark)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_materialize_writes_under_checkpoint_dir(spark):
    root = checkpoint_dir(spark)
    df = materialize(spark.range(10), "t")
    assert df.count() == 10
    files = df.inputFiles()
    assert files and all(root.rstrip("/").replace("file:", "") in f.replace("file:", "") for f in files)
    assert os.path.basename(os.path.dirname(files[0].replace("file:", ""))).startswith("propensia-t-")


def test_no_machine_local_folder_off_local_masters():
    import pytest

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
