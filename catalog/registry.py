"""Registered queries: a name, a function of (session, table folder), and SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.tables import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Rounded, without a negative zero, as the checking SQL does it."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; widen integers so that both engines agree on types."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            out.append(rnd(c.cast("double"), digits).alias(name))
        elif kind in ("tinyint", "smallint", "int"):
            out.append(c.cast("long").alias(name))
        else:
            out.append(c)
    return df.select(*out)


def r(expr: str, alias: str | None = None, digits: int = 6) -> str:
    text = f"round({expr}, {digits}) + 0.0::DOUBLE"
    return f"{text} AS {alias}" if alias else text
