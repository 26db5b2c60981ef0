"""Frequent values (top-k by count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, nulls: str = "keep", name: str = "count") -> DataFrame:
    """Rows per value of ``col``; ``nulls='keep'`` keeps the null group (Spark
    groupBy), ``'drop'`` removes it (pandas value_counts)."""
    src = df.where(F.col(col).isNotNull()) if nulls == "drop" else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def frequent(df: DataFrame, col: str, k: int = 20, nulls: str = "keep", name: str = "count") -> DataFrame:
    """Top ``k`` values by count, ties by value (nulls first). The sort + limit
    is planned as a distributed top-k, not a full sort."""
    counts = value_counts(df, col, nulls, name)
    return counts.orderBy(F.col(name).desc(), F.col(col).asc_nulls_first()).limit(k)
