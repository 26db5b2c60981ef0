"""Joining reviews to items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Equi-join keeping one copy of the key. Duplicated keys on the right
    multiply rows (see :func:`match_report`). Adaptive execution picks a
    broadcast from measured sizes and splits skewed left-side keys."""
    return left.join(right, on, how)


def match_report(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """One row: left_rows, matched_rows, unmatched_rows, output_rows (after
    fan-out), dup_keys (right keys present more than once).

    Both sides are reduced to (key, multiplicity) before the join, so a hot key
    is one row on either side whatever the fan-out.
    """
    mult = right.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_m"))
    dups = mult.agg(F.count(F.when(F.col("_m") > 1, F.lit(1))).alias("dup_keys"))
    keys = left.groupBy(on).agg(F.count(F.lit(1)).alias("_l"))
    j = keys.join(mult, on, "left")

    def rows(n: Column, name: str) -> Column:
        return F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(name)

    agg = j.agg(rows(F.col("_l"), "left_rows"),
                rows(F.when(F.col("_m").isNotNull(), F.col("_l")), "matched_rows"),
                rows(F.when(F.col("_m").isNull(), F.col("_l")), "unmatched_rows"),
                rows(F.col("_l") * F.coalesce(F.col("_m"), F.lit(1)), "output_rows"))
    return agg.select("*", dups.select("dup_keys").scalar().alias("dup_keys"))


def merged_features(reviews: DataFrame, items: DataFrame, on: str, score: str, count: str,
                    time_col: str | None = None, text: str | None = None, drop: list[str] | None = None,
                    zone: str = "UTC") -> DataFrame:
    """Left-join reviews to items and derive the analysis columns: score and
    count as double (unparsable -> null), ``review_year`` from the Unix time,
    ``review_length`` as the single-space word count of ``text``."""
    from quire.functions.scalar import unix_to_timestamp, word_count
    m = merge(reviews, items, on, "left")
    m = m.withColumns({score: F.col(score).try_cast("double"), count: F.col(count).try_cast("double")})
    if time_col:
        m = m.withColumn("review_year", F.year(unix_to_timestamp(F.col(time_col).try_cast("bigint"), zone)).cast("int"))
    if text:
        m = m.withColumn("review_length", word_count(text))
    if drop:  # after deriving, so a source column may be dropped
        m = m.drop(*[c for c in drop if c in m.columns])
    return m
