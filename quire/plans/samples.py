"""Registered queries: sampling, splits, the review-item join."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import enrich, sampling
from quire.plans.params import TRAIN_SEED
from quire.plans.registry import query
from quire.sources import fixtures as fx

_M, _A = sampling.HASH_MODULUS, sampling.HASH_MULTIPLIER


def _bucket_sql(key: str, seed: int) -> str:
    return f"((({key} % {_M}) + {_M}) % {_M} * {_A} + {seed}) % {_M}"


@query("sample_hash", f"""select review_id, user_id, score_raw from reviews_fx
where {_bucket_sql('review_id', TRAIN_SEED)} < {round(0.1 * _M)}""")
def sample_hash(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "user_id", "score_raw")
    return sampling.bernoulli(r, 0.1, TRAIN_SEED, key="review_id")


@query("sample_bernoulli")
def sample_bernoulli(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "user_id", "score_raw")
    return sampling.bernoulli(r, 0.1, TRAIN_SEED)


@query("split_sizes", f"""select case when {_bucket_sql('review_id', TRAIN_SEED)} < {round(0.8 * _M)} then 'train'
  else 'test' end as split, count(*) as rows from reviews_fx group by 1""")
def split_sizes(spark, sf):
    r = sampling.split_label(fx.reviews_fx(spark, sf), {"train": 0.8, "test": 0.2}, TRAIN_SEED, "review_id")
    return r.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("split_random_sizes")
def split_random_sizes(spark, sf):
    train, test = sampling.split(fx.reviews_fx(spark, sf), [0.8, 0.2], TRAIN_SEED)
    return (train.select(F.lit("train").alias("split")).unionByName(test.select(F.lit("test").alias("split")))
            .groupBy("split").agg(F.count(F.lit(1)).alias("rows")))


@query("split_string_key", """select count(*) as rows, count(distinct title) as titles, cast(0 as bigint) as titles_in_both
from merged_fx""")
def split_string_key(spark, sf):
    """A split keyed on text with nulls: every row is in one part, every title in one."""
    m = fx.merged_fx(spark, sf).select("title")
    parts = sampling.split_label(m, {"train": 0.8, "test": 0.2}, TRAIN_SEED, "title")
    per = parts.where("split is not null").groupBy("title").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("split").alias("parts"))
    return per.agg(F.sum("n").alias("rows"), F.count("title").alias("titles"),
                   F.count(F.when(F.col("parts") > 1, 1)).alias("titles_in_both"))


@query("merge_left", """select r.review_id, r.item_id, b.title, b.categories, r.score_raw
from reviews_fx r left join books_fx b on r.item_id = b.item_id""")
def merge_left(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "item_id", "score_raw")
    b = fx.books_fx(spark, sf).select("item_id", "title", "categories")
    return enrich.merge(r, b, "item_id", "left")


@query("merge_match_report", """with mult as (select item_id, count(*) as m from books_fx where item_id is not null
  group by item_id)
select count(*) as left_rows, count(mult.m) as matched_rows, count(*) filter (where mult.m is null) as unmatched_rows,
  cast(sum(coalesce(mult.m, 1)) as bigint) as output_rows, (select count(*) filter (where m > 1) from mult) as dup_keys
from reviews_fx r left join mult on r.item_id = mult.item_id""")
def merge_match_report(spark, sf):
    return enrich.match_report(fx.reviews_fx(spark, sf), fx.books_fx(spark, sf), "item_id")


@query("merge_title_fanout", """with mult as (select title, count(*) as m from books_fx where title is not null
  group by title)
select count(*) as left_rows, count(mult.m) as matched_rows, count(*) filter (where mult.m is null) as unmatched_rows,
  cast(sum(coalesce(mult.m, 1)) as bigint) as output_rows, (select count(*) filter (where m > 1) from mult) as dup_keys
from merged_fx r left join mult on r.title = mult.title""")
def merge_title_fanout(spark, sf):
    return enrich.match_report(fx.merged_fx(spark, sf), fx.books_fx(spark, sf), "title")
