"""Run a registered query and its SQL twin and compare them as bags of rows."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, result: duckdb.DuckDBPyConnection) -> str | None:
    """None when equal, else a short account of the first difference."""
    sql_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} / {sorted(sql_columns)}"
    a, b = _plain(df.columns, df.collect()), _plain(sql_columns, result.fetchall())
    if not a:
        return "no rows"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(differing)} rows differ, first {differing[0]}" if differing else None
