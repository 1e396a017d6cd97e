"""Runs registered queries against their SQL in DuckDB and reports differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def difference(spark, con, folder: str, query, sql: str) -> str | None:
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(sql)
    want = rows_of(res.columns, res.fetchall())
    if sorted(df.columns) != sorted(res.columns):
        return f"columns {sorted(df.columns)} vs {sorted(res.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, first {str(bad[0][0])[:400]} vs {str(bad[0][1])[:400]}"
    if not got:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tuneweave.session import build_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without sql:", sorted(set(queries) - set(oracle)), "without query:", sorted(set(oracle) - set(queries)))
    for name in queries:
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                bad = difference(spark, con, folder, queries[name], oracle[name])
            else:
                bad = f"rows only: {len(queries[name](spark, folder).collect())}"
        except Exception as exc:
            bad = "ERROR " + str(exc)[:500]
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if bad is None else bad}", flush=True)
