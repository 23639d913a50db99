"""Spark-vs-DuckDB comparison in the driver's manner: names, types, row count, order-free values.

CLI: ``python tests/oracle_harness.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT",
                 "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(v))            # exact: the SQL forms reproduce Spark's arithmetic order
    return (3, str(v))


def _rows(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in idx) for r in rows]
    out.sort()
    return out


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    s_cols = [c for c, _ in s_types]
    res = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    res["names_ok"] = sorted(s_cols) == sorted(d_cols)
    s_map = {c: SPARK_TO_DUCK.get(t, t) for c, t in s_types}
    d_map = dict(zip(d_cols, d_types))
    res["type_diffs"] = {c: (s_map[c], d_map.get(c)) for c in s_map if s_map[c] != d_map.get(c)}
    res["values_ok"] = res["names_ok"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    res["ok"] = res["values_ok"] and not res["type_diffs"] and len(s_rows) > 0
    if res["names_ok"] and not res["values_ok"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_duck"] = [x for x in b if x not in sa][:3]
    if not res["names_ok"]:
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from dockcast.session import build_session
    spark = build_session()
    con = duck_connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            n = df.count()
            print({"key": k, "rows_only": n, "ok": n >= 0})
            continue
        try:
            r = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as ex:  # report and continue
            r = {"key": k, "ok": False, "error": str(ex)[:400]}
        bad += 0 if r["ok"] else 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
