"""Registered queries: the analysis questions (item, user, category, time)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import reshape, stats, timeseries, topk
from quire.operators.layout import stage_table
from quire.plans.frames import ANALYSIS_SQL, analysis_frame
from quire.plans.params import TOP_RATED_MIN, YEARS
from quire.plans.registry import query, rounded
from quire.sources import fixtures as fx

W = f"with {ANALYSIS_SQL}\n"


@query("book_stats", """select item_id, count(score) as review_count, round(avg(score), 6) as avg_review_score
from merged_fx group by item_id""")
def book_stats(spark, sf):
    return rounded(stats.item_stats(fx.merged_fx(spark, sf)), ["avg_review_score"])


@query("most_reviewed_books", """select item_id, count(score) as review_count, round(avg(score), 6) as avg_review_score
from merged_fx group by item_id order by review_count desc, item_id asc limit 10""")
def most_reviewed_books(spark, sf):
    s = stats.item_stats(fx.merged_fx(spark, sf))
    return rounded(stats.most_reviewed(s, "item_id", 10), ["avg_review_score"])


@query("top_rated_books", f"""select item_id, count(score) as review_count, round(avg(score), 6) as avg_review_score
from merged_fx group by item_id having count(score) > {TOP_RATED_MIN}
order by avg(score) desc, item_id asc limit 10""")
def top_rated_books(spark, sf):
    s = stats.item_stats(fx.merged_fx(spark, sf))
    return rounded(stats.top_rated(s, "item_id", TOP_RATED_MIN, 10), ["avg_review_score"])


@query("books_having_min_reviews", f"""select item_id, count(score) as review_count, round(avg(score), 6) as avg_review_score
from merged_fx group by item_id having count(score) > {TOP_RATED_MIN}""")
def books_having_min_reviews(spark, sf):
    s = stats.item_stats(fx.merged_fx(spark, sf))
    return rounded(stats.having_min(s, TOP_RATED_MIN), ["avg_review_score"])


@query("user_features", """select user_id, round(avg(score), 6) as avg_review_score, count(score) as num_reviews,
  round(avg(review_length), 6) as avg_review_length from merged_fx group by user_id""")
def user_features(spark, sf):
    uf = stats.user_features(fx.merged_fx(spark, sf))
    return rounded(uf, ["avg_review_score", "avg_review_length"])


@query("reviews_by_category", W + """select categories_s as categories, count(score) as review_count
from ana group by categories_s""")
def reviews_by_category(spark, sf):
    return stats.count_by(analysis_frame(spark, sf), "categories")


@query("reviews_by_keys", W + """select 'categories' as key_name, categories_s as key, count(score) as review_count from ana group by 2
union all select 'authors', authors_s, count(score) from ana group by 2
union all select 'user_id', cast(user_id as string), count(score) from ana group by 2""")
def reviews_by_keys(spark, sf):
    """The counts per category, author and user from one scan."""
    return stats.count_by_each(analysis_frame(spark, sf), ["categories", "authors", "user_id"])


@query("reviews_by_user", """select user_id, count(score) as num_reviews from merged_fx group by user_id""")
def reviews_by_user(spark, sf):
    return stats.count_by(fx.merged_fx(spark, sf), "user_id", name="num_reviews")


@query("reviews_by_author", W + """select authors_s as authors, count(score) as num_reviews
from ana group by authors_s""")
def reviews_by_author(spark, sf):
    return stats.count_by(analysis_frame(spark, sf), "authors", name="num_reviews")


@query("category_year_counts", W + """select categories_s as categories, review_year, count(score) as review_count
from ana group by categories_s, review_year""")
def category_year_counts(spark, sf):
    return stats.count_by(analysis_frame(spark, sf), ["categories", "review_year"])


@query("yearly_avg_score", W + """select review_year, round(avg(score), 6) as avg_score
from ana where review_year is not null group by review_year""")
def yearly_avg_score(spark, sf):
    return rounded(stats.yearly_mean(analysis_frame(spark, sf)), ["avg_score"])


@query("yearly_review_count", W + """select review_year, count(score) as review_count
from ana where review_year is not null group by review_year""")
def yearly_review_count(spark, sf):
    return stats.yearly_count(analysis_frame(spark, sf))


_PIVOT_COLS = ",\n  ".join(f"count(case when review_year = {y} then score end) as \"{y}\"" for y in YEARS)


@query("category_year_pivot", W + f"""select categories_s as categories,
  {_PIVOT_COLS}
from ana where categories_s is not null group by categories_s""")
def category_year_pivot(spark, sf):
    return reshape.pivot_years(analysis_frame(spark, sf), "categories", "review_year", YEARS)


@query("trend_top_categories", W + """, top as (
  select categories_s, count(score) as n from ana group by categories_s
  order by n desc, categories_s asc nulls first limit 10)
select categories_s as categories, review_year, count(score) as review_count
from ana where categories_s in (select categories_s from top where categories_s is not null)
group by categories_s, review_year""")
def trend_top_categories(spark, sf):
    # One pass: count per (category, year), then rank categories by their
    # summed counts on that small table and keep the top 10 (semi-join, <= 10 rows).
    trend = stage_table(stats.count_by(analysis_frame(spark, sf), ["categories", "review_year"]), "trend")
    top = (trend.groupBy("categories").agg(F.sum("review_count").alias("total"))
                .orderBy(F.col("total").desc(), F.col("categories").asc_nulls_first()).limit(10))
    return trend.join(F.broadcast(top.select("categories")), "categories", "left_semi")


@query("monthly_volume", """with per as (
  select date_trunc('month', review_ts) as period, count(score) as n from merged_fx
  where review_ts is not null group by 1),
cal as (select unnest(generate_series(min(period), max(period), interval 1 month)) as period from per)
select cal.period, coalesce(per.n, 0) as count from cal left join per on cal.period = per.period""")
def monthly_volume(spark, sf):
    return timeseries.resample(fx.merged_fx(spark, sf), "review_ts", "month", value="score")


@query("daily_volume_gaps", """with per as (
  select date_trunc('day', ts) as period, count(case when not isnan(value) then value end) as n from gap_fx
  where ts is not null group by 1),
cal as (select unnest(generate_series(min(period), max(period), interval 1 day)) as period from per)
select cal.period, coalesce(per.n, 0) as count from cal left join per on cal.period = per.period""")
def daily_volume_gaps(spark, sf):
    return timeseries.resample(fx.gap_fx(spark, sf), "ts", "day", value="value")


@query("category_share_top10", W + """, top as (
  select categories_s as categories, count(*) as count from ana where categories_s is not null
  group by categories_s order by count desc, categories asc limit 10)
select categories, count, round(count * 100.0 / sum(count) over (), 1) as pct from top""")
def category_share_top10(spark, sf):
    return stats.share_of_top(analysis_frame(spark, sf), "categories", 10)


@query("top_values_drop_null", W + """select categories_s as categories, count(*) as count from ana
where categories_s is not null group by categories_s order by count desc, categories asc limit 10""")
def top_values_drop_null(spark, sf):
    return topk.frequent(analysis_frame(spark, sf), "categories", 10, nulls="drop")


@query("top_values_keep_null", """select categories, count(*) as count from books_fx
group by categories order by count desc, categories asc nulls first limit 20""")
def top_values_keep_null(spark, sf):
    return topk.frequent(fx.books_fx(spark, sf), "categories", 20, nulls="keep")


@query("corr_matrix", """with cc as (select score as a1, ratings_count as a2, cast(review_length as double) as a3 from merged_fx
  where score is not null and ratings_count is not null and review_length is not null)
select a, b, round(r, 6) as r from (
  select 'score' as a, 'score' as b, corr(a1, a1) as r from cc union all
  select 'score', 'ratings_count', corr(a1, a2) from cc union all
  select 'score', 'review_length', corr(a1, a3) from cc union all
  select 'ratings_count', 'score', corr(a2, a1) from cc union all
  select 'ratings_count', 'ratings_count', corr(a2, a2) from cc union all
  select 'ratings_count', 'review_length', corr(a2, a3) from cc union all
  select 'review_length', 'score', corr(a3, a1) from cc union all
  select 'review_length', 'ratings_count', corr(a3, a2) from cc union all
  select 'review_length', 'review_length', corr(a3, a3) from cc)""")
def corr_matrix(spark, sf):
    cm = stats.corr_matrix(fx.merged_fx(spark, sf), ["score", "ratings_count", "review_length"])
    return rounded(cm, ["r"])


@query("popularity_vs_score", """select count(*) as n, round(corr(ratings_count, score), 6) as r from merged_fx
where ratings_count is not null and score is not null""")
def popularity_vs_score(spark, sf):
    return rounded(stats.corr_pair(fx.merged_fx(spark, sf), "ratings_count", "score"), ["r"])


@query("monthly_volume_from_year", W + """, per as (
  select make_date(review_year, 1, 1) as d, count(score) as n from ana where review_year is not null group by 1),
cal as (select unnest(generate_series(min(d), max(d), interval 1 month)) as period from per)
select cast(cal.period as timestamp) as period, coalesce(per.n, 0) as count from cal left join per on cal.period = per.d""")
def monthly_volume_from_year(spark, sf):
    """Monthly volume when only the year is known (each year's reviews fall on
    1 January, the other months are 0) - the year-precision input case."""
    from quire.functions.scalar import year_to_date
    a = analysis_frame(spark, sf).withColumn("review_date", year_to_date("review_year").cast("timestamp_ntz"))
    return timeseries.resample(a, "review_date", "month", value="score")


@query("top_authors", W + """select authors_s as authors, count(*) as count from ana where authors_s is not null
group by authors_s order by count desc, authors asc limit 10""")
def top_authors(spark, sf):
    return topk.frequent(analysis_frame(spark, sf), "authors", 10, nulls="drop")


@query("top_titles", """select title, count(*) as count from merged_fx where title is not null
group by title order by count desc, title asc limit 10""")
def top_titles(spark, sf):
    return topk.frequent(fx.merged_fx(spark, sf), "title", 10, nulls="drop")
