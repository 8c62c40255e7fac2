"""Compares a Spark result with DuckDB's answer to the matching SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """Empty when columns and all rows agree."""
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} against {sorted(relation.columns)}"]
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(relation.fetchall(), relation.columns)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    return [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b][:3]
