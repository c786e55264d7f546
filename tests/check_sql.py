"""Compare registered queries with their SQL in DuckDB: ``python tests/check_sql.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


def differences(spark_rows, spark_cols, sql_rows, sql_cols) -> str | None:
    """A description of the first difference, or None."""
    if sorted(spark_cols) != sorted(sql_cols):
        return f"columns {sorted(spark_cols)} / {sorted(sql_cols)}"
    order = sorted(spark_cols)
    a = sorted(([r[spark_cols.index(c)] for c in order] for r in spark_rows), key=_key)
    b = sorted(([r[sql_cols.index(c)] for c in order] for r in sql_rows), key=_key)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        for c, v, w in zip(order, x, y):
            if v is None or w is None:
                same = v is w
            elif isinstance(v, bool) or isinstance(w, bool) or isinstance(v, str):
                same = v == w and type(v) is type(w)
            elif isinstance(v, int) and isinstance(w, int):
                same = v == w
            else:
                same = type(v) is float and type(w) is float and (v == w or math.isclose(v, w, rel_tol=1e-9))
            if not same:
                return f"{c}: {v!r} ({type(v).__name__}) / {w!r} ({type(w).__name__}) in {str(x)[:300]} / {str(y)[:300]}"
    return None


# Spark types and the DuckDB types they correspond to.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_differences(df, description) -> list[str]:
    sql = {d[0]: str(d[1]) for d in description}
    return [f"{f.name}: {f.dataType.simpleString()} / {sql[f.name]}" for f in df.schema.fields
            if TYPES.get(f.dataType.simpleString()) != sql.get(f.name)]


def main() -> int:
    from prefloom.session import build_session
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        try:
            start = time.time()
            df = E.queries()[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            sql = E.oracle_sql().get(name)
            if sql is None:
                print(f"{took:6.2f}s -    {name}: {len(rows)} rows {rows[:1]}", flush=True)
                continue
            start = time.time()
            res = con.execute(sql)
            cols = [d[0] for d in res.description]
            types = type_differences(df, res.description)
            found = differences(rows, df.columns, res.fetchall(), cols) or (f"types {types}" if types else None)
            bad += found is not None
            print(f"{took:6.2f}s {time.time() - start:5.2f}s {'ok ' if found is None else 'BAD'} {name}: {len(rows)} rows {found or ''}", flush=True)
        except Exception as err:
            bad += 1
            print(f"FAIL {name}: {str(err)[:600]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
