import os
import subprocess
import sys

import __spark_entry__ as E  # noqa: E402

from conftest import SF0001
from propensia.plans.queries import ORACLE, QUERIES


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 14
    assert "engagement_segment" in df.columns


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(ORACLE) == {"model_scores"}


def test_oracle_agreement_sf0001():
    """Every registered query against its DuckDB SQL (driver-style compare)."""
    names = list(ORACLE)
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "oracle_check.py")
    res = subprocess.run([sys.executable, script, SF0001, *names], capture_output=True, text=True, timeout=1800)
    assert res.returncode == 0, res.stdout[-4000:]


def test_caller_session_settings_do_not_change_results(spark):
    """ANSI off, another session zone, more shuffle partitions: same answers."""
    import duckdb

    from conftest import SF001
    from oracle_check import rows_of

    con = duckdb.connect()
    for t in ("customer", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        for name in ["gold_orders", "request_scoring", "score_deciles", "evaluation_metrics"]:
            df = E.queries()[name](spark, SF001)
            res = con.execute(E.oracle_sql()[name])
            assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
                [d[0] for d in res.description], res.fetchall()
            ), name
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
