"""Reports as tables: sections of key/value lines, schema dumps, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.ranking import dense_index


def section(title: str, df: DataFrame, order: list[Column]) -> DataFrame:
    """Every row of ``df`` as ``key: value`` lines: (section, row_no, key, value).
    ``row_no`` is 1-based in ``order``; values are text."""
    cols = list(df.columns)
    idx = dense_index(df, order, name="_i")
    as_text = idx.select(F.lit(title).alias("section"), (F.col("_i") + 1).alias("row_no"),
                         *[F.col(c).cast("string").alias(c) for c in cols])
    return as_text.unpivot(["section", "row_no"], cols, "key", "value")


def combine(*sections: DataFrame) -> DataFrame:
    """Stack report sections into one table."""
    return reduce(lambda a, b: a.unionByName(b), sections)


def schema_table(spark: SparkSession, df: DataFrame, with_nulls: bool = False) -> DataFrame:
    """(position, column, type, nullable) of ``df``'s schema; with ``with_nulls``
    also the number of null (or NaN) values per column, from one aggregation."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    out = spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")
    if not with_nulls:
        return out
    from quire.operators.profile import missing
    miss = missing(df)
    long = miss.select([F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).unpivot(
        [], [f"c{i}" for i in range(len(df.columns))], "_c", "nulls")
    long = long.select(F.substring("_c", 2, 10).cast("int").alias("position"), "nulls")
    return out.join(F.broadcast(long), "position")  # one row per column


def text_block(spark: SparkSession, title: str, text: str) -> DataFrame:
    """A free-text section in the same (section, row_no, key, value) shape."""
    rows = [(title, i + 1, "text", line) for i, line in enumerate(text.splitlines() or [""])]
    return spark.createDataFrame(rows, "section string, row_no bigint, key string, value string")


def metrics(spark: SparkSession, model: str, values: dict[str, float]) -> DataFrame:
    """(model, metric, value) rows for evaluation results."""
    return spark.createDataFrame([(model, k, float(v)) for k, v in values.items()],
                                 "model string, metric string, value double")
