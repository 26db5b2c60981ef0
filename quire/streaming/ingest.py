"""Incremental ingest: delimited text files landing in a folder -> parquet.

The batch ingest (:func:`quire.sources.read_csv` + :func:`quire.sources.write_parquet`)
rewrites everything each run. This streaming form picks up only the files
that arrived since the last run: the file source records what it has read in
the checkpoint folder (shared storage), so a restarted or failed run resumes
exactly once. ``available_now`` processes the backlog and stops, which suits
scheduled jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from quire.session import scratch_path


def ingest_csv_stream(spark: SparkSession, landing: str, schema: StructType, out: str,
                      checkpoint: str | None = None, strict_quotes: bool = True,
                      max_files_per_trigger: int | None = None, available_now: bool = True, multi_line: bool = True):
    """Start (and, with ``available_now``, finish) a CSV -> parquet stream.

    A streaming file source needs the schema up front (no inference). ``multi_line`` (default, as files
    still to come cannot be checked) allows line breaks inside quoted fields; each file is then one task.
    Without it, files are split, and a field with a line break would become two rows.
    Returns the finished (or running) StreamingQuery.
    """
    reader = spark.readStream.schema(schema).option("header", True)
    if strict_quotes:
        reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.csv(landing)
    writer = (stream.writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "ingest-ckpt"))
              .outputMode("append"))
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()
