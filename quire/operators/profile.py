"""Profiling: missing counts, describe / summary, row counts, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from quire.functions.scalar import is_missing
from quire.operators.layout import stage_table
from quire.operators.quantile import quantiles_long
from quire.operators.ranking import top_k_per_group


def missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: per column, rows that are null (or NaN for float columns)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = cols or df.columns
    return df.agg(*[F.count(F.when(is_missing(c, types[c]), F.lit(1))).alias(c) for c in cols])


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row with the row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def head(df: DataFrame, cols: list[str], n: int, order: list[str | Column]) -> DataFrame:
    """First ``n`` rows by a stable order (a distributed top-n, not a full sort)."""
    return df.select(*cols).orderBy(*order).limit(n)


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form (column, count, mean, stddev, min, max) in one pass.

    Like ``DataFrame.describe``: count of non-null, mean and sample std of the
    values that read as numbers (text that does not parse is skipped), min and
    max in the column's own order (lexicographic for text), given as text.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = cols or [c for c in df.columns if isinstance(types[c], (StringType, NumericType))]
    aggs = []
    for i, c in enumerate(cols):
        num = F.col(c).try_cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(num).alias(f"m{i}"), F.stddev_samp(num).alias(f"s{i}"),
                 F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def overview(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """Missing counts, describe and top values of all columns from one scan, long form (column, item, rank, value, number).

    Columns are unpivoted to (column, value as text) and counted once; every statistic comes from those counts. Items:
    ``rows``, ``missing`` (null or NaN), ``count``, ``mean``, ``stddev`` (sample; of what reads as a number), ``min`` and ``max``
    (the smallest and largest number of a numeric column, else text in ``value``), and ``top`` (rank 1 to ``k``: ``value``, null
    included, with its count in ``number``; ties by value, null first). A column without any number has no mean or stddev row, an
    empty table no rows but ``rows`` and ``missing`` of 0."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    numeric = [c for c in cols if isinstance(types[c], NumericType)]
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = stage_table(text.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    of_number = F.col("column").isin(*numeric)
    gone = F.col("value").isNull() | (of_number & (F.col("value") == "NaN"))
    x = F.when(~gone, F.col("value").try_cast("double"))
    x = F.when(~F.isnan(x), x)
    one = counts.withColumns({"x": x, "gone": gone}).groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(F.col("x").isNotNull(), F.col("n"))).alias("numbers"), F.sum(F.col("x") * F.col("n")).alias("total"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.min("x").alias("least"), F.max("x").alias("most"))
    one = one.withColumn("mean", F.col("total") / F.col("numbers"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    one = stage_table(names.join(one, "column", "left"), "column-stats")  # one row per column
    off = F.col("x") - F.col("mean")
    spread = counts.withColumn("x", x).join(F.broadcast(one.select("column", "mean")), "column").groupBy("column").agg(
        F.sum(F.col("n") * off * off).alias("squares"))
    one = one.join(spread, "column", "left").withColumn(
        "stddev", F.when(F.col("numbers") > 1, F.sqrt(F.col("squares") / (F.col("numbers") - 1))))
    item = lambda name, value, number: F.struct(F.lit(name).alias("item"), F.lit(None).cast("int").alias("rank"),
                                                value.cast("string").alias("value"), number.cast("double").alias("number"))
    null, ends = F.lit(None), F.col("count") > 0
    stats = [item("rows", null, F.coalesce("rows", F.lit(0))), item("missing", null, F.coalesce("missing", F.lit(0))),
             F.when(ends, item("count", null, F.col("count"))), F.when(F.col("numbers") > 0, item("mean", null, F.col("mean"))),
             F.when(F.col("numbers") > 1, item("stddev", null, F.col("stddev")))]
    for name, text_end, number_end in (("min", "lo", "least"), ("max", "hi", "most")):
        stats.append(F.when(ends, F.when(of_number, item(name, null, F.col(number_end))).otherwise(item(name, F.col(text_end), null))))
    flat = one.select("column", F.inline(F.array_compact(F.array(*stats))))
    ranked = counts.withColumn("no_value", F.col("value").isNull().cast("int"))
    top = top_k_per_group(ranked, ["column"], [F.desc("n"), F.desc("no_value")], k, ["value"])
    top = top.select("column", F.lit("top").alias("item"), "rank", "value", F.col("n").cast("double").alias("number"))
    return flat.unionByName(top)


def _every_column(stats: DataFrame, cols: list[str]) -> DataFrame:
    """One row per listed column, also where there are no statistics."""
    names = stats.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(stats, "column", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def summary(df: DataFrame, cols: list[str], probs: dict[str, float] | None = None,
            exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Long form (column, count, mean, stddev, min, p25, p50, p75, max); numeric
    values, null, NaN and text that is no number ignored. A column without any value keeps its row: count 0, rest null.

    The columns are unpivoted to (column, value), so every statistic is one
    grouped aggregation keyed by the column name. ``exact`` gives discrete
    quantiles taken from the data; ``exact=False`` uses Spark's approximate
    percentile (as ``DataFrame.summary`` does): one pass, a bounded sketch per
    column, rank error at most n / ``accuracy``.
    """
    probs = probs or {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    long = df.select(*[F.col(c).try_cast("double").alias(c) for c in cols]).unpivot(
        ids=[], values=cols, variableColumnName="column", valueColumnName="value")
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    basic = long.groupBy("column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("stddev"), F.min("value").alias("min"),
                                       F.max("value").alias("max"))
    if not exact:
        approx = F.percentile_approx("value", list(probs.values()), accuracy)
        out = long.groupBy("column").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min"), F.max("value").alias("max"), approx.alias("_q"))
        out = out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)]).drop("_q")
        return _every_column(out, cols).select("column", "count", "mean", "stddev", "min", *probs.keys(), "max")
    q = quantiles_long(long, "value", list(probs.values()), method="disc", by=["column"])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n)
                                   for n, p in probs.items()])
    out = _every_column(basic.join(qw, "column", "left"), cols)
    return out.select("column", "count", "mean", "stddev", "min", *probs.keys(), "max")
