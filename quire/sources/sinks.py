"""Batch sinks and model persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None,
                  partition_by: list[str] | None = None) -> str:
    """Write parquet. ``partitions`` fixes the file count (a shuffle); otherwise
    the writer keeps the upstream partitioning that adaptive execution chose."""
    out = df.repartition(partitions) if partitions else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", strict_quotes: bool = True) -> str:
    """Write delimited text with a header; RFC 4180 quoting by default."""
    writer = df.write.mode(mode).option("header", True)
    if strict_quotes:
        writer = writer.option("quote", '"').option("escape", '"').option("quoteAll", True)
    writer.csv(path)
    return path


def save_model(model, path: str) -> str:
    """Persist any Spark ML model or pipeline, replacing what is there."""
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    """Load a model saved by :func:`save_model`; ``cls`` is its model class."""
    return cls.load(path)
