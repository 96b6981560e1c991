"""Run catalogue checks in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows
(doubles rounded to 6 decimals, columns sorted by name).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb


sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                  "smallint": "SMALLINT", "float": "FLOAT"}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = df.collect()
    t1 = time.time()
    scols = df.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), sec=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    type_diff = []
    for f in df.schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString())
        got = dtypes.get(f.name)
        if want and got and want != got.upper():
            type_diff.append((f.name, f.dataType.simpleString(), got))
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows)
    detail = ""
    if sorted(scols) != sorted(dcols):
        detail = f"cols spark={sorted(scols)} duck={sorted(dcols)}"
    elif len(srows) != len(drows):
        detail = f"rows spark={len(srows)} duck={len(drows)}"
    else:
        a = rows_of(scols, srows)
        b = rows_of(dcols, drows)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            detail = f"values differ e.g. {diff}"
    return dict(name=name, ok=ok, rows=len(srows), sec=round(t1 - t0, 2), detail=detail,
                types=type_diff)


def main():
    from quartermaster.session import local_session
    import __spark_entry__ as e
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("QM_PLAIN_SESSION") == "1":
        # the driver's kind of session: defaults only
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = local_session(8)
    if os.environ.get("QM_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["QM_TZ"])
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as ex:  # noqa: BLE001
            r = dict(name=name, ok=False, detail=f"{type(ex).__name__}: {str(ex)[:400]}")
        if r["ok"] is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
