"""Registered queries: scalar functions over whole columns and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import scalar
from quire.plans.registry import query
from quire.sources import fixtures as fx


@query("fn_unix_to_text", """select review_id, review_time,
  strftime(make_timestamp(review_time * 1000000), '%Y-%m-%d %H:%M:%S') as review_time_text from reviews_fx""")
def fn_unix_to_text(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "review_time")
    return r.withColumn("review_time_text", scalar.unix_to_text("review_time", "UTC"))


@query("fn_review_year", """select review_id, cast(year(make_timestamp(review_time * 1000000)) as integer) as review_year
from reviews_fx""")
def fn_review_year(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "review_time")
    return r.select("review_id", scalar.text_to_year(scalar.unix_to_text("review_time")).alias("review_year"))


@query("fn_review_length", """select doc_id, cast(len(string_split(text, ' ')) as integer) as review_length from docs_fx""")
def fn_review_length(spark, sf):
    return fx.docs_fx(spark, sf).select("doc_id", scalar.word_count("text").alias("review_length"))


@query("fn_strip_list", """select item_id, regexp_replace(categories, '[\\[\\]'']', '', 'g') as categories,
  regexp_replace(authors, '[\\[\\]'']', '', 'g') as authors from books_fx""")
def fn_strip_list(spark, sf):
    b = fx.books_fx(spark, sf)
    return b.select("item_id", scalar.strip_list("categories").alias("categories"),
                    scalar.strip_list("authors").alias("authors"))


@query("fn_normalize_text", """select doc_id, regexp_replace(lower(text), '[^a-z \\t\\n\\r\\f\\x0B]', '', 'g') as text_norm
from docs_fx""")
def fn_normalize_text(spark, sf):
    return fx.docs_fx(spark, sf).select("doc_id", scalar.normalize_text("text").alias("text_norm"))


@query("fn_year_to_date", """select review_id,
  cast(make_date(cast(year(make_timestamp(review_time * 1000000)) as integer), 1, 1) as timestamp) as review_date
from reviews_fx""")
def fn_year_to_date(spark, sf):
    r = fx.reviews_fx(spark, sf)
    y = scalar.text_to_year(scalar.unix_to_text("review_time"))
    return r.select("review_id", scalar.year_to_date(y).cast("timestamp_ntz").alias("review_date"))


@query("fn_round", """select user_id, round(avg(score), 2) as avg_score_2, round(avg(review_length), 4) as avg_length_4
from merged_fx group by user_id""")
def fn_round(spark, sf):
    m = fx.merged_fx(spark, sf)
    return m.groupBy("user_id").agg(F.round(F.avg("score"), 2).alias("avg_score_2"),
                                    F.round(F.avg("review_length"), 4).alias("avg_length_4"))


@query("fn_year_to_date_dirty", """select item_id, cast(make_date(try_cast('19' || lpad(ratings_raw, 2, '0') as integer), 1, 1)
  as timestamp) as published from books_fx""")
def fn_year_to_date_dirty(spark, sf):
    """Text that is no year, and null, give null."""
    year = F.concat(F.lit("19"), F.lpad("ratings_raw", 2, "0"))
    return fx.books_fx(spark, sf).select("item_id", scalar.year_to_date(year).cast("timestamp_ntz").alias("published"))
