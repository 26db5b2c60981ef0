"""Grouped statistics behind the analysis questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.topk import frequent


def item_stats(df: DataFrame, key: str = "item_id", value: str = "score") -> DataFrame:
    """Per item: non-null score count and mean score."""
    return df.groupBy(key).agg(F.count(value).alias("review_count"), F.avg(value).alias("avg_review_score"))


def most_reviewed(stats: DataFrame, key: str = "item_id", k: int = 10) -> DataFrame:
    """Top ``k`` items by review count (ties by key)."""
    return stats.orderBy(F.col("review_count").desc(), F.col(key).asc()).limit(k)


def top_rated(stats: DataFrame, key: str = "item_id", min_count: int = 50, k: int = 10) -> DataFrame:
    """Top ``k`` by mean score among items with more than ``min_count`` reviews."""
    return (stats.where(F.col("review_count") > min_count)
                 .orderBy(F.col("avg_review_score").desc(), F.col(key).asc()).limit(k))


def having_min(stats: DataFrame, min_count: int = 50) -> DataFrame:
    """Items with more than ``min_count`` scored reviews (filter after the aggregate)."""
    return stats.where(F.col("review_count") > min_count)


def user_features(df: DataFrame, user: str = "user_id", score: str = "score",
                  length: str = "review_length") -> DataFrame:
    """Per user: scored-review count, mean score, mean review length."""
    return df.groupBy(user).agg(
        F.avg(score).alias("avg_review_score"),
        F.count(score).alias("num_reviews"),
        F.avg(length).cast("double").alias("avg_review_length"),
    )


def count_by(df: DataFrame, keys: list[str] | str, value: str = "score", name: str = "review_count",
             nulls: str = "keep") -> DataFrame:
    """Non-null ``value`` count per key (combination)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    src = df
    if nulls == "drop":
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    return src.groupBy(*keys).agg(F.count(value).alias(name))


def count_by_each(df: DataFrame, keys: list[str], value: str = "score", name: str = "review_count",
                  nulls: str = "keep") -> DataFrame:
    """Counts of non-null ``value`` per value of each key, as (key_name, key, count) with keys as text.

    One scan, one expand and one shuffle for all keys (GROUPING SETS), instead of a scan per key. ``nulls='drop'`` leaves a
    key's null group out."""
    text = df.select(*[F.col(k).cast("string").alias(f"_{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"))
    cols = [f"_{i}" for i in range(len(keys))]
    found = text.groupingSets([[c] for c in cols], *cols).agg(
        F.count("_v").alias(name), *[F.grouping(c).alias(f"g{c}") for c in cols])
    own = [(F.col(f"g{c}") == 0, F.lit(k), F.col(c)) for c, k in zip(cols, keys)]
    out = found.select(F.coalesce(*[F.when(is_own, label) for is_own, label, _ in own]).alias("key_name"),
                       F.coalesce(*[F.when(is_own, k) for is_own, _, k in own]).alias("key"), name)
    return out.where(F.col("key").isNotNull()) if nulls == "drop" else out


def yearly_mean(df: DataFrame, year: str = "review_year", value: str = "score") -> DataFrame:
    """Mean per year; null years dropped (as a pandas group-by does)."""
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(F.avg(value).alias("avg_score"))


def yearly_count(df: DataFrame, year: str = "review_year", value: str = "score") -> DataFrame:
    """Non-null ``value`` count per year; null years dropped."""
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(F.count(value).alias("review_count"))


def share_of_top(df: DataFrame, col: str, k: int = 10, decimals: int = 1) -> DataFrame:
    """Top ``k`` values (nulls dropped) with their percentage of the top-k total."""
    top = frequent(df, col, k, nulls="drop")
    total = F.sum("count").over(Window.partitionBy())  # over at most k rows
    return top.withColumn("pct", F.round(F.col("count") * 100.0 / total, decimals))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every ordered pair over complete rows, long form (a, b, r)."""
    cc = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop(how="any")
    pairs = [(a, b) for a in cols for b in cols]
    one = cc.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows)))


def corr_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, r) over rows where both are present."""
    cc = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop(how="any")
    return cc.agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("r"))
