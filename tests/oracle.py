"""Compare a Spark result with DuckDB's answer, row for row and order-free."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con.execute(sql).df()


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame()
    for column in sorted(df.columns):
        values = df[column]
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.astype("datetime64[us]").astype("string")
        elif pd.api.types.is_float_dtype(values):
            values = values.map(lambda v: "" if pd.isna(v) else repr(float(v)))
        else:
            values = values.map(lambda v: "" if v is None or v is pd.NA else str(v))
        out[column] = values.fillna("").astype(str)
    return out.sort_values(list(out.columns), ignore_index=True)


def differences(spark_df, sql: str, sf_dir: str) -> list[str]:
    """Empty when both sides agree on columns, types' families, rows and values."""
    got, want = spark_df.toPandas(), duck(sql, sf_dir)
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"{len(got)} rows != {len(want)}"]
    a, b = _canonical(got), _canonical(want)
    problems = []
    for column in a.columns:
        off = a[column] != b[column]
        if off.any():
            i = off.idxmax()
            problems.append(f"{column}: {int(off.sum())} differ, e.g. {a[column][i]!r} != {b[column][i]!r}")
    return problems
