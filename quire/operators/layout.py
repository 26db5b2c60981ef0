"""Caching and lineage cuts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from quire.session import ensure_checkpoint_dir, scratch_path


def cache(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, materialize: bool = True) -> DataFrame:
    """Persist at a reuse point (memory, spilling to disk); optionally force it now."""
    out = df.persist(level)
    if materialize:
        out.count()
    return out


def pin(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where later steps must see exactly the same partitioning as an
    earlier one (e.g. partition ids after a range shuffle). Survives executor
    loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # Persist first: the checkpoint write then reads the computed blocks
    # instead of recomputing the whole input a second time.
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def stage_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back; ``compression`` other than the session's for large tables."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)
