"""Run a catalog query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.cursor()
    cur.execute(sql)
    cols = [d[0] for d in cur.description]
    return sorted(cols), normal(cols, cur.fetchall())


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    cols, rows = spark_rows(df)
    want_cols, want = duck_rows(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if rows == want:
        return None
    extra = [r for r in rows if r not in set(want)][:3]
    missing = [r for r in want if r not in set(rows)][:3]
    return f"{len(rows)} rows vs {len(want)}; only spark {extra}; only sql {missing}; columns {cols}"
