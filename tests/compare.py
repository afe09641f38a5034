"""Order-free comparison of a Spark result with DuckDB's."""

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, (bool,)) or type(v).__name__ in ("bool_", "bool"):
        return str(bool(v))
    if isinstance(v, (int, float)) or hasattr(v, "dtype") and not hasattr(v, "__len__") or type(v).__name__ == "Decimal":
        try:
            return f"{float(v):.6f}".rstrip("0").rstrip(".")
        except (TypeError, ValueError):
            pass
    return str(v)[:19].replace(" 00:00:00", "") if hasattr(v, "isoformat") else str(v)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))
