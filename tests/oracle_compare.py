"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""
import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        s = str(v)
        return s[:10] if s[10:].strip(" 0:") == "" else s
    return v


def rows(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    out = [tuple(_norm(x) for x in r) for r in df.itertuples(index=False)]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return f"rows {len(spark_pdf)} vs {len(oracle_pdf)}"
    a, b = rows(spark_pdf), rows(oracle_pdf)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"values differ, e.g. {diffs}"
    return None
