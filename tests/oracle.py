"""Side-by-side comparison of a registered query and its DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

from lakeloom.registry import TABLE_NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: [(x is None, str(type(x)), str(x)) for x in r])


def compare(df, con, sql: str) -> str | None:
    """None if equal, else a short description of the first difference."""
    spark_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    sc, sr = _sorted(df.columns, spark_rows)
    oc, orows = _sorted(names, rel.fetchall())
    if sc != oc:
        return f"columns {sc} != {oc}"
    if len(sr) != len(orows):
        only = [r for r in sr if r not in set(orows)][:2]
        other = [r for r in orows if r not in set(sr)][:2]
        return f"rows {len(sr)} != {len(orows)}; spark only {only}; sql only {other}"
    if not sr:
        return "both empty"
    kinds = [{type(r[i]).__name__ for r in sr if r[i] is not None} for i in range(len(sc))]
    okinds = [{type(r[i]).__name__ for r in orows if r[i] is not None} for i in range(len(sc))]
    if kinds != okinds:
        bad = [(c, k, o) for c, k, o in zip(sc, kinds, okinds) if k != o]
        return f"types {bad}"
    diff = [(a, b) for a, b in zip(sr, orows) if a != b]
    if diff:
        return f"{len(diff)} of {len(sr)} rows differ; cols {sc}; spark {diff[0][0]}; sql {diff[0][1]}"
    return None
