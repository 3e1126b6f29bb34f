"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.6f}") + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def check(spark, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duck(sf_dir)
    answer = con.sql(sql)
    names, want = answer.columns, rows_of(answer.columns, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            near = [(sorted(names)[i], x, y) for i, (x, y) in enumerate(zip(a, b)) if x != y]
            return f"{near[:3]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from chamberlens.session import build_session

    spark = build_session("compare")
    sf = sys.argv[1]
    only = sys.argv[2:]
    for name, query in e.queries().items():
        if only and name not in only:
            continue
        begun = time.time()
        try:
            if name in e.oracle_sql():
                result = check(spark, sf, query, e.oracle_sql()[name]) or "ok"
            else:
                result = f"rows {len(query(spark, sf).collect())}"
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - begun:6.1f}s {result}", flush=True)
