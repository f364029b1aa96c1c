"""Compares a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def plain(value):
    """One form for values that both engines may type differently."""
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def bag(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def spark_bag(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), bag(df.collect(), df.columns)


def duck_bag(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as con:
        for p in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
        got = con.execute(sql)
        columns = [c[0] for c in got.description]
        return sorted(columns), bag(got.fetchall(), columns)
