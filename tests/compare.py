"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import datetime
import math
import sys
import tempfile
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def kind(value) -> str:
    return type(value).__name__


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def kinds(columns, rows):
    found = {}
    for row in rows:
        for name, value in zip(columns, row):
            if value is not None:
                found.setdefault(name, set()).add(kind(value))
    return found


def difference(df, con, sql: str) -> str | None:
    rows = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    other = result.fetchall()
    mine, theirs = normal(df.columns, rows), normal(names, other)
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"row counts {len(mine[1])} != {len(theirs[1])}"
    a, b = kinds(df.columns, rows), kinds(names, other)
    if a != b:
        return f"types {a} != {b}"
    wrong = [(x, y) for x, y in zip(mine[1], theirs[1]) if x != y]
    if wrong:
        return f"{len(wrong)} rows differ, first {str(wrong[0][0])[:400]} != {str(wrong[0][1])[:400]}"
    return None


def main(folder: str, only: list[str]) -> None:
    import __spark_entry__ as entry
    from tastelens.session import local_session

    spark = local_session(8, scratch=tempfile.mkdtemp(prefix="compare-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                problem = difference(df, con, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{kind(error)}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
