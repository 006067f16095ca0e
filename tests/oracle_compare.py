"""Spark-vs-DuckDB comparison: row count, column names and order-insensitive values.

Usable from pytest and as a script: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck_type(t) -> str:
    """The DuckDB type name a Spark column type corresponds to."""
    from pyspark.sql import types as T

    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE",
              T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
              T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE"}
    for cls, name in simple.items():
        if isinstance(t, cls):
            return name
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return t.simpleString()


def compare(spark, key: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, map(str, rel.types)))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    s_types = {f.name: duck_type(f.dataType) for f in sdf.schema.fields}
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diffs"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                             if s_types.get(c) != d_types.get(c)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb, key=str)[:3]
        out["only_oracle"] = sorted(sb - sa, key=str)[:3]
    out["ok"] = (out["columns_match"] and out["types_match"] and out["values_match"]
                 and len(s_rows) == len(d_rows))
    return out


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or sorted(entry.oracle_sql())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, qs[k], sqls[k], sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"key": k, "ok": False, "error": repr(exc)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
