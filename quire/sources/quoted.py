"""Delimited text with line breaks inside quoted fields, read by many tasks per file.

Whether a line break ends a record depends on the number of quotes before it in the file. Every split of the scan counts its
quotes; a running sum over the splits of a file (one narrow row each) says whether a split starts inside a quoted
field. With that, each split finds its record starts by itself. A record that crosses splits leaves one fragment in each of them,
at most two per split, and only fragments are shuffled; whole records go straight to Spark's CSV parser."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: What a row of ``_pieces`` is: a record, the end (or middle) of one begun in an earlier split, or the begin of one that goes on.
RECORD, LATER, BEGUN = 0, 1, 2
_PIECE = "file long, block long, kind int, first boolean, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): physical lines in order, with the split they belong to."""
    # only \n ends a line here: a carriage return may belong to a field
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _quotes(value: Column) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))


def split_parity(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a split starts inside a quoted field. One row per split of the scan."""
    counted = lines.groupBy("file", "block").agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """Runs of lines joined by line breaks; ``ends`` are the positions after each run's last line."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments from the lines of the splits of one task."""
    split, held, inside, begun, header = None, [], False, False, False

    def rows(kind: int, values: pa.Array) -> pa.RecordBatch:
        nonlocal header
        if kind == RECORD:
            values = pc.utf8_rtrim(values, "\r")
            values = values.filter(pc.not_equal(pc.utf8_trim_whitespace(values), ""))  # blank lines are no records
        n = len(values)
        first = np.zeros(n, bool)
        if header and n:
            first[0], header = True, False
        return pa.RecordBatch.from_arrays([pa.array([split[0]] * n, pa.int64()), pa.array([split[1]] * n, pa.int64()),
                                           pa.array([kind] * n, pa.int32()), pa.array(first), values.cast(pa.string())],
                                          names=["file", "block", "kind", "first", "value"])

    def left() -> Iterator[pa.RecordBatch]:
        if held:
            yield rows(BEGUN if begun else LATER, pa.array(["\n".join(held)]))

    for batch in batches:
        files, blocks = (batch.column(c).to_numpy() for c in ("file", "block"))
        edges = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for at, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            if at == end:
                continue
            if split != (int(files[at]), int(blocks[at])):
                yield from left()
                split, held = (int(files[at]), int(blocks[at])), []
                inside = batch.column("inside")[at].as_py()
                begun, header = not inside, split[1] == 0
            values = batch.column("value").slice(at, end - at)
            after = (np.cumsum(pc.count_substring(values, '"').to_numpy()) + inside) % 2 == 1
            ends = np.flatnonzero(~after) + 1  # a record ends where no quote is open
            inside = bool(after[-1])
            if len(ends) and (held or not begun):
                lead = pa.array(["\n".join([*held, *values[:ends[0]].to_pylist()])])
                yield rows(RECORD if begun else LATER, lead)
                values, ends, held, begun = values[ends[0]:], ends[1:] - ends[0], [], True
            if len(ends):
                yield rows(RECORD, _joined(values[:ends[-1]], ends))
                values = values[ends[-1]:]
            held += values.to_pylist()
    yield from left()


def _pieces(lines: DataFrame) -> DataFrame:
    # one row per split of the scan, which the driver lists anyway to plan it: bounded by the number of tasks
    parity = F.broadcast(split_parity(lines))
    return lines.join(parity, ["file", "block"]).select("file", "block", "inside", "value").mapInArrow(_assemble, _PIECE)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(value, first): every record of the files as text, and whether it is the first of its file.

    Quotes follow RFC 4180 (a quote stands only around a field or doubled inside it). Blank lines are left out; a record whose
    quote never closes runs to the end of its file."""
    pieces = _pieces(_lines(spark, path))
    whole = pieces.where(F.col("kind") == RECORD).select("value", "first")
    begun = Window.partitionBy("file").orderBy("block", "kind")
    chained = pieces.where(F.col("kind") != RECORD).withColumn("chain", F.count(F.when(F.col("kind") == BEGUN, 1)).over(begun))
    parts = F.array_sort(F.collect_list(F.struct("block", "value")))
    crossing = chained.groupBy("file", "chain").agg(parts.alias("parts"), F.max("first").alias("first")).select(
        F.rtrim(F.array_join(F.col("parts.value"), "\n"), F.lit("\r")).alias("value"), "first")
    return whole.unionByName(crossing)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with quoted line breaks, split over tasks; two passes over the text.

    Without a schema every column is text, named by the first header. Each file's first record is its header (``header``)."""
    found = records(spark, path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    if schema is None:
        top = found.where("first").select("value").limit(1).first()  # one row
        if top is None:
            raise ValueError(f"{path}: no record to take column names from; pass a schema")
        width = spark.range(1).select(F.schema_of_csv(F.lit(top["value"]), options).alias("s")).first()["s"]
        names = [f"_c{i}" for i in range(len(StructType.fromDDL(width[len("STRUCT<"):-1]).fields))]
        if header:
            plain = ", ".join(f"{n} string" for n in names)
            row = spark.range(1).select(F.from_csv(F.lit(top["value"]), plain, options).alias("r")).first()["r"]
            names = [v if v is not None else n for n, v in zip(names, row)]
        schema = StructType([StructField(n, StringType()) for n in names])
    body = found.where(~F.col("first")) if header else found
    fields = [f"c{i}" for i in range(len(schema))]
    plain = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(fields, schema))
    parsed = body.select(F.from_csv("value", plain, options).alias("r"))
    return parsed.select(*[F.col(f"r.{n}").alias(f.name) for n, f in zip(fields, schema)])
