"""Compare registered queries with their DuckDB oracle (driver-style).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normalise(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return normalise(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normalise(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "SMALLINT": "smallint",
}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}


def main():
    import duckdb

    import __spark_entry__ as E
    from propensia.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("oracle-check", cpus=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        recs = [tuple(r) for r in df.collect()]
        dt = time.time() - t0
        if name not in sql:
            print(f"{name:28s} rows={len(recs):7d} (no oracle) {dt:.1f}s")
            continue
        res = con.execute(sql[name])
        ocols = [d[0] for d in res.description]
        orecs = res.fetchall()
        ok_cols = sorted(cols) == sorted(ocols)
        stypes = dict(df.dtypes)
        dtypes_ = duck_types(con, sql[name])
        type_diff = {c: (stypes.get(c), dtypes_.get(c)) for c in stypes if stypes.get(c) != dtypes_.get(c)}
        if type_diff:
            print(f"   TYPES differ in {name}: {type_diff}")
        ok_rows = len(recs) == len(orecs)
        a, b = rows_of(cols, recs), rows_of(ocols, orecs)
        ok_vals = ok_cols and a == b
        status = "OK " if (ok_cols and ok_rows and ok_vals) else "BAD"
        bad += status == "BAD"
        print(f"{status} {name:28s} rows={len(recs):7d}/{len(orecs):7d} cols={'ok' if ok_cols else (cols, ocols)} vals={'ok' if ok_vals else 'DIFF'} {dt:.1f}s")
        if not ok_vals and ok_cols:
            in_a, in_b = set(a), set(b)
            diff_a = [r for r in a if r not in in_b][:3]
            diff_b = [r for r in b if r not in in_a][:3]
            print("   spark-only:", diff_a)
            print("   oracle-only:", diff_b)
            print("   columns:", sorted(cols))
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
