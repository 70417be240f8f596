"""Queries over the test tables, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import Grid

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The grid that (l_suppkey, l_partkey) are rows and columns of.
GRID = Grid(x0=500000.0, y0=7000000.0)
CELLS_SQL = "select *, l_suppkey::int as grid_row, l_partkey::int as grid_col, 5e5 + (l_partkey + 5e-1) * 3e1 as x_utm, 7e6 - (l_suppkey + 5e-1) * 3e1 as y_utm from lineitem"


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """lineitem as grid cells with their centres and the wanted columns."""
    df = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("grid_row"), F.col("l_partkey").cast("int").alias("grid_col"), *cols)
    return df.withColumns({"x_utm": (F.col("grid_col") + 0.5) * GRID.dx + GRID.x0, "y_utm": F.lit(GRID.y0) - (F.col("grid_row") + 0.5) * GRID.dy})


def r6(c: str | Column, name: str | None = None, digits: int = 6) -> Column:
    """Rounded for comparison, without a negative zero."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col, digits) + F.lit(0.0)).alias(name or c)
