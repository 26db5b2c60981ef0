"""Pivot of counts to a fixed column list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_years(df: DataFrame, key: str, year: str, years: list[int], value: str = "score") -> DataFrame:
    """Rows = ``key`` (nulls dropped), one column per year in ``years`` holding
    the non-null ``value`` count; years outside the list are dropped, missing
    cells are 0. The value list is given, so Spark needs no extra pass to
    find the pivot values."""
    src = df.where(F.col(key).isNotNull())
    out = src.groupBy(key).pivot(year, list(years)).agg(F.count(value))
    return out.na.fill(0, [str(y) for y in years])
