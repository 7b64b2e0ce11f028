"""Side-by-side check of a registered query against its DuckDB oracle SQL.

Row count, column names and an order-insensitive hash of normalised values,
the same three facts the driver's correctness gate compares.
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import math


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.timedelta):
        return str(v.total_seconds())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck_connection(sf_dir: str):
    import duckdb

    from ..sources.tables import TABLES, table_path
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, name: str, sf_dir: str, queries: dict, sql: dict) -> dict:
    """Run both sides; return a report dict with ``ok`` and details."""
    df = queries[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    rep = {"name": name, "spark_rows": len(srows), "ok": None}
    if name not in sql:
        return rep
    res = con.execute(sql[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    hs, ls = digest(scols, srows)
    ho, lo = digest(ocols, orows)
    rep.update(oracle_rows=len(orows), cols_ok=sorted(scols) == sorted(ocols),
               ok=sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho)
    if not rep["ok"]:
        rep["spark_cols"], rep["oracle_cols"] = sorted(scols), sorted(ocols)
        rep["spark_only"] = sorted(set(ls) - set(lo))[:3]
        rep["oracle_only"] = sorted(set(lo) - set(ls))[:3]
    return rep
