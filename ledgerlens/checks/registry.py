"""Collects named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the operator it shows, with its SQL counterpart."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def snap(col: Column, digits: int = 6) -> Column:
    """Round to a grid with plain arithmetic, which every engine does alike."""
    grid = float(10**digits)
    return F.floor(col.cast("double") * grid + 0.5).cast("double") / grid


def snap_sql(expression: str, digits: int = 6) -> str:
    grid = f"CAST({10**digits} AS DOUBLE)"
    return f"(floor(CAST({expression} AS DOUBLE) * {grid} + 0.5) / {grid})"


def snap_text(expression: str, digits: int) -> str:
    """:func:`snap` as a select expression."""
    grid = f"{10**digits}D"
    return f"CAST(floor(CAST({expression} AS DOUBLE) * {grid} + 0.5D) AS DOUBLE) / {grid}"


def plain(df: DataFrame, digits: int = 4, snapped: set[str] | None = None) -> DataFrame:
    """Comparable types: integers as long, decimals as double, doubles on a grid."""
    columns = []
    for name, kind in df.dtypes:
        e = f"`{name}`"
        if kind in ("int", "smallint", "tinyint", "bigint"):
            e = f"CAST({e} AS BIGINT)"
        elif kind.startswith("decimal"):
            e = f"CAST({e} AS DOUBLE)"
        elif kind in ("double", "float") and (snapped is None or name in snapped):
            e = snap_text(e, digits)
        columns.append(f"{e} AS `{name}`")
    return df.selectExpr(*columns)
