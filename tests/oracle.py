"""Local stand-in for the driver's correctness gate.

Runs a registered Spark query and its DuckDB SQL on the same parquet tables
and compares row count, column names and values (order-insensitive, floats
to 1e-6).
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("0", "")
    if isinstance(v, float):
        if math.isnan(v):
            return ("0", "")
        return ("1", f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return ("1", str(int(v)))
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return ("1", repr([_norm(x) for x in list(v)]))
    if isinstance(v, pd.Timestamp):
        return ("1", str(v.to_pydatetime().replace(tzinfo=None)))
    return ("1", str(v))


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(out)


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row counts differ: spark={len(s)} duck={len(d)}"
    rs, rd = rows(s), rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(s)} rows match"
