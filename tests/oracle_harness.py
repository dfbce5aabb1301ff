"""Run a registered query on Spark and its SQL oracle on DuckDB; compare results."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Values are compared exactly, as a value hash would; TESSERA_ORACLE_TOL=1 relaxes
# floats to a 1e-4 relative tolerance when investigating a mismatch.
TOLERANT = os.environ.get("TESSERA_ORACLE_TOL", "") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5) if TOLERANT else v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5) if TOLERANT else float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _close(a, b):
    if not TOLERANT:
        return a == b
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-4 * max(1.0, abs(a), abs(b))
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return abs(a - b) <= 1e-4 * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols_s = spark_df.columns
    rows_s = [tuple(_norm(r[c]) for c in sorted(cols_s)) for r in spark_df.collect()]
    res = con.execute(sql)
    cols_d = [d[0] for d in res.description]
    raw = res.fetchall()
    if sorted(cols_s) != sorted(cols_d):
        return False, f"columns differ: spark={sorted(cols_s)} duck={sorted(cols_d)}"
    idx = [cols_d.index(c) for c in sorted(cols_d)]
    rows_d = [tuple(_norm(r[i]) for i in idx) for r in raw]
    if len(rows_s) != len(rows_d):
        return False, f"row count spark={len(rows_s)} duck={len(rows_d)}"
    key = lambda r: tuple((x is None, repr(x) if not isinstance(x, (int, float)) else round(float(x), 3)) for x in r)
    rs, rd = sorted(rows_s, key=key), sorted(rows_d, key=key)
    for a, b in zip(rs, rd):
        if len(a) != len(b) or not all(_close(x, y) for x, y in zip(a, b)):
            return False, f"row differs: spark={a} duck={b}"
    return True, f"{len(rs)} rows"
