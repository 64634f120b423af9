"""Comparison of a query with its SQL, order and float noise aside."""

import duckdb
import pandas as pd

from colloquy.tables import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "~"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    try:
        return repr(round(float(v), 6) + 0.0) if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))
