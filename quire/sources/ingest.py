"""Batch ingest: delimited text -> parquet (the first stage of the workflow)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from quire.sources.files import read_csv
from quire.sources.sinks import write_parquet


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: StructType | str | None = None,
                   strict_quotes: bool = True, partitions: int | None = None, multi_line: bool | str = False,
                   infer: bool = True) -> str:
    """Read CSV (RFC 4180 quoting by default) and write it as parquet.

    Give a schema for large inputs; inference costs an extra pass. ``multi_line="split"`` reads files with
    quoted line breaks in many tasks; with True they are read one per
    task, so their rows are spread over shuffle partitions before the write. For files that keep
    arriving use :func:`quire.streaming.ingest_csv_stream`.
    """
    if multi_line is True and partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = read_csv(spark, src, schema=schema, strict_quotes=strict_quotes, multi_line=multi_line, infer=infer)
    return write_parquet(rows, dst, partitions=partitions)
