"""Rows of a query and of its SQL in DuckDB, made comparable."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

DATA = "/root/testdata"


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return float(v) if type(v) is int else v
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return str(v)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def both(spark, query, sql: str, folder: str) -> tuple[list[str], list[tuple], list[str], list[tuple]]:
    df = query(spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = views(folder).execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(df.columns), got, sorted(names), rows(names, cur.fetchall())
