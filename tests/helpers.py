from __future__ import annotations

import math

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from souk import oracle


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return cols, sorted(out, key=key)


def same_rows(a: pd.DataFrame, b: pd.DataFrame, tol: float = 1e-9) -> bool:
    ca, ra = rows(a)
    cb, rb = rows(b)
    if ca != cb or len(ra) != len(rb):
        return False
    for x, y in zip(ra, rb):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                if u is None or v is None or not math.isclose(u, v, rel_tol=tol, abs_tol=tol):
                    return False
            elif u != v:
                return False
    return True


def duck_on_tables(tables: dict[str, DataFrame]) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with the clean tables registered under the oracle's CTE names."""
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(oracle.CTE[name], df.toArrow())
    return con


def oracle_body(sql: str) -> str:
    """Oracle SQL without the driver mapping, to run on registered clean tables."""
    # a statement without CTEs of its own follows the prelude without its last comma
    return sql.replace(oracle.PRELUDE, "WITH ").replace(oracle.Q, "")
