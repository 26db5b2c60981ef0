"""Batch file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.session import session_key
from quire.sources.quoted import read_quoted_csv


def _odd_quotes(spark: SparkSession, path: str) -> bool:
    """Whether some line has an odd number of quotes, so that a quoted field runs over a line break."""
    lines = spark.read.text(path)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, strict_quotes: bool = True,
             header: bool = True, multi_line: bool | str = False, check: bool = True, infer: bool = True) -> DataFrame:
    """Read delimited text with a header.

    ``strict_quotes`` (default) follows RFC 4180: doubled quotes inside a quoted field. ``False`` is the
    plain reader, which shifts columns on such rows. Large files are split over many tasks. Line breaks
    inside quoted fields need ``multi_line``: ``"split"`` finds the record starts of every split
    (:mod:`quire.sources.quoted`; columns without a schema are text), True reads each file in one task. Without it such files
    raise ValueError, as one more pass over the lines finds an odd number of quotes (``check=False``
    leaves that pass out). Without a schema the types are inferred (another pass), or all columns are
    text with ``infer=False``; pass a schema in production.
    """
    if multi_line == "split":
        if not strict_quotes:
            raise ValueError("splits of multi-line files need strict quotes")
        return read_quoted_csv(spark, path, schema, header)
    reader = spark.read.option("header", header)
    if strict_quotes:
        reader = reader.option("quote", '"').option("escape", '"')
        if multi_line:
            reader = reader.option("multiLine", True)
        elif check and _odd_quotes(spark, path):
            raise ValueError(f"{path}: quotes open at the end of a line; read it with multi_line=True")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Columnar scan; naming columns here makes the pruning explicit in ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


_TABLES: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One of the driver tables ``<sf_dir>/<name>.parquet``.

    The scan is resolved once per session and folder (file listing and footer
    schema), like a registered view; DataFrames are immutable, so sharing the
    resolved scan is safe. Column selection stays per call and prunes the read.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df.select(*columns) if columns else df
