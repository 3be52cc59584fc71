"""Runs catalogue queries next to their SQL and compares columns, types and rows.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pyarrow as pa

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        if glob.glob(f"{sf_dir}/{name}.parquet"):
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*[table.column(n).to_pylist() for n in names]), key=_key) if names else []


def _type(dtype: pa.DataType) -> str:
    if pa.types.is_large_string(dtype) or pa.types.is_string(dtype):
        return "string"
    return str(dtype)


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str:
    """Empty when both hold the same; otherwise what differs."""
    left = {f.name: _type(f.type) for f in spark_table.schema}
    right = {f.name: _type(f.type) for f in sql_table.schema}
    if left != right:
        return f"schema {dict(set(left.items()) ^ set(right.items()))} spark={left} sql={right}"
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows {spark_table.num_rows} != {sql_table.num_rows}"
    for a, b in zip(_rows(spark_table), _rows(sql_table)):
        if a != b and not all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b)):
            return f"value {a} != {b}"
    return ""


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from plantspark.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    wanted, sql = queries(), oracle_sql()
    names = args[1:] or list(wanted)
    failures = []
    for name in names:
        began = time.time()
        try:
            got = wanted[name](spark, sf_dir).toArrow()
            seconds = time.time() - began
            problem = difference(got, con.sql(sql[name]).to_arrow_table()) if name in sql else ""
            if not got.num_rows:
                problem = problem or "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            seconds, problem, got = time.time() - began, f"{type(error).__name__}: {str(error)[:600]}", None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {got.num_rows if got else 0:8d} rows {seconds:6.2f}s "
              f"{'' if name in sql else '(no SQL) '}{problem}", flush=True)
        if problem:
            failures.append(name)
    print("failures:", failures, "missing sql:", [n for n in wanted if n not in sql], "unused sql:",
          [n for n in sql if n not in wanted])
    return len(failures)


if __name__ == "__main__":
    sys.exit(main())
