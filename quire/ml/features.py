"""Feature preparation: standardisation, vector assembly, label indexing."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.ranking import dense_index


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - mean) / population std per column; a constant column divides by 1.

    Means and stds come from one aggregation and reach the rows as scalar
    subqueries (no join).
    """
    stats = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)])
    out = {}
    for i, c in enumerate(cols):
        m = stats.select(f"m_{i}").scalar()
        s = stats.select(f"s_{i}").scalar()
        scale = F.when((s.isNull()) | (s == 0), F.lit(1.0)).otherwise(s)
        out[c + suffix] = (F.col(c).cast("double") - m) / scale
    return df.withColumns(out)


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """Columns -> one vector column; rows with a null feature are skipped."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def index_labels(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Label table (col, index): 0-based by falling frequency, ties by value.

    Same numbering as ``StringIndexer(stringOrderType='frequencyDesc')``, but
    the label list stays distributed (StringIndexer collects every label on
    the driver, which fails at hundreds of millions of users).
    """
    out = out or f"{col}_index"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    idx = dense_index(counts, [F.col("_n").desc(), F.col(col).asc()], name=out)
    return idx.select(col, F.col(out).cast("double").alias(out))


def string_index(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Attach the frequency index of ``col`` (rows with a null key are dropped)."""
    labels = index_labels(df, col, out)
    return df.join(labels, col)
