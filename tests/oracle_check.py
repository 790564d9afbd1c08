"""Compare each registered Spark query with its DuckDB oracle SQL.

Strict: same column names, compatible types, same row multiset with floats
compared bit-exactly (NaN == NaN).  Usage:
    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP", "DateType": "DATE", "FloatType": "FLOAT",
    "ShortType": "SMALLINT", "ByteType": "TINYINT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: type(f.dataType).__name__ for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    msg = f"spark {t1 - t0:.1f}s rows={len(s_rows)} duck rows={len(d_rows)}"
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{msg} columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
    bad_types = [(c, s_types[c], d_types[c]) for c in s_cols
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types[c]
                 and not (s_types[c] in ("ArrayType", "StructType"))]
    if bad_types:
        return False, f"{msg} types differ: {bad_types}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        return False, f"{msg} row counts differ"
    from collections import Counter
    cs, cd = Counter(s_norm), Counter(d_norm)
    only_s, only_d = list((cs - cd).elements()), list((cd - cs).elements())
    if only_s or only_d:
        return False, (f"{msg} {len(only_s)} rows differ; spark-only: {sorted(only_s, key=_key)[:2]} "
                       f"duck-only: {sorted(only_d, key=_key)[:2]} cols={order}")
    return True, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from climark.session import build_session
    from climark.plans import catalog
    spark = build_session("local[8]", shuffle_partitions=8)
    catalog.load_all()
    con = duck(sf_dir)
    ok_all = True
    for name, fn in catalog.QUERIES.items():
        if names and name not in names:
            continue
        sql = catalog.ORACLE.get(name)
        if sql is None:
            t0 = time.time()
            try:
                n = fn(spark, sf_dir).count()
                print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            except Exception as e:  # noqa: BLE001
                ok_all = False
                print(f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        try:
            ok, msg = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        ok_all &= ok
        print(f"{'PASS' if ok else 'FAIL'}  {name}: {msg}", flush=True)
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
