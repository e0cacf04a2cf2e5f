"""Where registered queries and their DuckDB counterparts are kept."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the DuckDB text that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(value: Any) -> str:
    """A Python value as SQL."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value}::DOUBLE" if isinstance(value, float) else str(value)


def expected(columns: str, rows: Sequence[tuple]) -> str:
    """SQL of rows written down by hand: ``columns`` as name and DuckDB type, joined by commas."""
    names = [c.split() for c in columns.split(", ")]
    values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return f"SELECT {', '.join(f'CAST({n} AS {t}) AS {n}' for n, t in names)} FROM (VALUES {values}) t({', '.join(n for n, _ in names)})"
