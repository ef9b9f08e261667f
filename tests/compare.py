"""Spark query vs DuckDB oracle: row count, column types and exact values (order-insensitive).

CLI: python -m tests.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SPARK_TO_DUCK = {
    T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
    T.DateType: "DATE", T.BooleanType: "BOOLEAN", T.TimestampNTZType: "TIMESTAMP", T.ShortType: "SMALLINT",
    T.FloatType: "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, key: str, spark_df, sql: str) -> dict:
    t0 = time.time()
    s_cols = spark_df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType), f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = [tuple(_norm(x) for x in r) for r in spark_df.collect()]
    t_spark = time.time() - t0
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types_list = [str(d[1]) for d in rel.description]
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    d_types = dict(zip(d_cols, d_types_list))
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t_spark, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        out["type_mismatch"] = bad_types
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_sorted = sorted((tuple(r[i] for i in si) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[i] for i in di) for r in d_rows), key=_key)
    if s_sorted != d_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        out["error"] = f"values differ ({order}); first diffs: {diff}"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tillcast.session import build_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for k in keys or sorted(oracles):
        try:
            res = compare(spark, con, k, qs[k](spark, sf), oracles[k])
        except Exception as e:  # noqa: BLE001
            res = {"key": k, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = "error" not in res and "type_mismatch" not in res
        failures += not ok
        print(("OK   " if ok else "FAIL ") + str(res), flush=True)
    print(f"{failures} failing")
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
