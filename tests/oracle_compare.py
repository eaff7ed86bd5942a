"""Compare a Spark result with a DuckDB oracle query on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

from jobscope.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) if abs(v) < 1e12 else float(f"{v:.9e}")
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(_norm(r[c]) for c in cols))
    return cols, out


def oracle_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, [tuple(_norm(row[i]) for i in order) for row in data]


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def compare(df, con, sql):
    """Return (ok, message)."""
    s_cols, s_rows = spark_rows(df)
    o_cols, o_rows = oracle_rows(con, sql)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(s_rows) != len(o_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(o_rows)}"
    a = sorted(s_rows, key=_key)
    b = sorted(o_rows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} oracle={y}"
    return True, f"{len(a)} rows equal"
