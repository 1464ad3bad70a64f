"""Run registered queries against their SQL: ``python -m harness.compare sf0.01 [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from harness.catalog import QUERIES
from harness.oracle import ORACLE
from partflow.session import get_spark

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check(spark, con, sf_dir: str, name: str) -> tuple[str, float, float]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    spent = time.time() - start
    if name not in ORACLE:
        return f"rows only: {len(ours)}", spent, 0.0
    start = time.time()
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    sql_spent = time.time() - start
    if sorted(df.columns) != sorted(columns):
        return f"COLUMNS {sorted(df.columns)} / {sorted(columns)}", spent, sql_spent
    if len(ours) != len(theirs):
        return f"ROWS {len(ours)} / {len(theirs)}", spent, sql_spent
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"VALUES {len(bad)} of {len(ours)}, first: {bad[0][0]!s:.700} / {bad[0][1]!s:.700}", spent, sql_spent
    return f"ok {len(ours)}", spent, sql_spent


def main(argv: list[str]) -> int:
    sf_dir = f"/root/testdata/{argv[0]}"
    spark = get_spark("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                      spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        try:
            verdict, spent, sql_spent = check(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            verdict, spent, sql_spent = f"ERROR {type(e).__name__}: {e!s:.900}", 0.0, 0.0
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {spent:7.2f}s sql {sql_spent:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
