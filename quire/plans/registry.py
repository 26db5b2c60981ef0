"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.fixture_sql import with_views

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

# Doubles are rounded to this many decimals on both sides of the oracle check.
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register a query builder, with its oracle SQL when one exists."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return deco


def rnd(c: str | Column, digits: int = DIGITS) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits)


def rounded(df: DataFrame, cols: list[str], digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
