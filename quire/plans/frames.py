"""Shared derived frames of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scalar import strip_list, unix_to_text, unix_to_timestamp, word_count
from quire.sources import fixtures as fx


def analysis_frame(spark: SparkSession, sf: str) -> DataFrame:
    """merged_fx with list brackets stripped from categories/authors, the
    review time as text and its year."""
    m = fx.merged_fx(spark, sf)
    # The year is read off the local time directly; it equals the year of the
    # text form (no per-row format + parse), and the text column is only
    # computed when a query selects it.
    return m.withColumns({
        "categories": strip_list("categories"),
        "authors": strip_list("authors"),
        "review_time_text": unix_to_text("review_time", "UTC"),
        "review_year": F.year(unix_to_timestamp("review_time", "UTC")).cast("int"),
    })


# SQL of the same frame (uses the merged_fx view).
ANALYSIS_SQL = """ana as (
  select *, regexp_replace(categories, '[\\[\\]'']', '', 'g') as categories_s,
         regexp_replace(authors, '[\\[\\]'']', '', 'g') as authors_s,
         cast(year(make_timestamp(review_time*1000000)) as integer) as review_year
  from merged_fx)"""


def text_frame(spark: SparkSession, sf: str) -> DataFrame:
    """docs_fx with word count (single-space split)."""
    return fx.docs_fx(spark, sf).withColumn("review_length", word_count("text"))
