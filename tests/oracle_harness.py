"""Local stand-in for the driver's correctness gate: run a registered Spark
query and its DuckDB oracle on the same parquet tables and compare row
count, column names and order-insensitive values."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = True  # exact float equality: both sides must round the same columns themselves


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    schema = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
    left = sdf.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    right = rel.df()
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": (len(left), len(right)),
           "schema": schema}
    mapping = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
               "float": "FLOAT", "boolean": "BOOLEAN"}
    type_bad = [(n, t, duck_types.get(n)) for n, t in schema
                if mapping.get(t, t) != duck_types.get(n)]
    if type_bad:
        out["types"] = type_bad
    if sorted(left.columns) != sorted(right.columns):
        out["ok"] = False
        out["why"] = f"columns {sorted(left.columns)} vs {sorted(right.columns)}"
        return out
    a, b = _rows(left), _rows(right)
    if len(a) != len(b):
        out["ok"] = False
        out["why"] = "row count"
        return out
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    out["ok"] = not bad
    if bad:
        out["why"] = f"{len(bad)} rows differ, e.g. {bad[:3]}"
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from propensity.session import build_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            t0 = time.time()
            try:
                n = fn(spark, sf_dir).count()
                print(f"ROWS  {name}: {n} rows ({time.time()-t0:.1f}s)")
            except Exception as e:  # noqa
                fails += 1
                print(f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa
            fails += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}")
            continue
        fails += not r["ok"]
        print(("OK    " if r["ok"] else "FAIL  ") + f"{name}: rows={r['rows']} {r['spark_sec']}s"
              + ("" if r["ok"] else "  " + r["why"][:600])
              + (f"  TYPES {r['types']}" if r.get("types") else ""))
    print("failures:", fails)
