"""Registered queries: data behind distribution charts."""

from __future__ import annotations

from quire.operators import distribution, stats
from quire.plans.frames import text_frame
from quire.plans.registry import query, rounded
from quire.sources import fixtures as fx


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""with v as (select cast({col} as double) as v from {src} where {col} is not null and not isnan(cast({col} as double))),
b as (select min(v) as lo0, max(v) as hi0 from v),
e as (select case when lo0 = hi0 then lo0 - 0.5 else lo0 end as lo, case when lo0 = hi0 then hi0 + 0.5 else hi0 end as hi
      from b where lo0 is not null),
c as (select least(cast(floor((v - lo) / (hi - lo) * {bins}) as integer), {bins - 1}) as bin, count(*) as n from v, e group by 1),
f as (select cast(i as integer) as bin from range({bins}) t(i))
select f.bin, round(lo + f.bin * ((hi - lo) / {bins}), 6) as lower, round(lo + (f.bin + 1) * ((hi - lo) / {bins}), 6) as upper,
  coalesce(c.n, 0) as count from f cross join e left join c on f.bin = c.bin"""


_USERS = """(select user_id, count(score) as num_reviews, avg(score) as avg_review_score,
  avg(review_length) as avg_review_length from merged_fx group by user_id) u"""
_TEXTS = "(select len(string_split(text, ' ')) as review_length from docs_fx) d"


@query("hist_score", _hist_sql("merged_fx", "score", 10))
def hist_score(spark, sf):
    return rounded(distribution.histogram(fx.merged_fx(spark, sf), "score", 10), ["lower", "upper"])


@query("hist_user_reviews", _hist_sql(_USERS, "num_reviews", 30))
def hist_user_reviews(spark, sf):
    uf = stats.user_features(fx.merged_fx(spark, sf))
    return rounded(distribution.histogram(uf, "num_reviews", 30), ["lower", "upper"])


@query("hist_user_avg_score", _hist_sql(_USERS, "avg_review_score", 20))
def hist_user_avg_score(spark, sf):
    uf = stats.user_features(fx.merged_fx(spark, sf))
    return rounded(distribution.histogram(uf, "avg_review_score", 20), ["lower", "upper"])


@query("hist_length", _hist_sql("merged_fx", "review_length", 50))
def hist_length(spark, sf):
    return rounded(distribution.histogram(fx.merged_fx(spark, sf), "review_length", 50), ["lower", "upper"])


@query("hist_text_length", _hist_sql(_TEXTS, "review_length", 50))
def hist_text_length(spark, sf):
    return rounded(distribution.histogram(text_frame(spark, sf), "review_length", 50), ["lower", "upper"])


def _kde_sql(src: str, col: str, grid: int = 200, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    gw = f"where {by} is not null" if by else ""
    join = f"using ({by})" if by else "on true"
    return f"""with v as (select {g}cast({col} as double) as v from {src} where {col} is not null and not isnan(cast({col} as double)) {('and ' + by + ' is not null') if by else ''}),
st as (select {g}count(*) as n, stddev_samp(v) as sd, min(v) as lo, max(v) as hi from v {('group by ' + by) if by else ''}),
p as (select {g}n, lo, pow(n, -0.2) * sd as h, case when hi > lo then (hi - lo) / {grid - 1} else 1.0 end as step from st),
g as (select cast(i as integer) as point from range({grid}) t(i)),
d as (select {('p.' + by + ', ') if by else ''}g.point, lo + g.point * step as x,
        sum(exp(-0.5 * ((lo + g.point * step - v) / h) * ((lo + g.point * step - v) / h))) / (n * h * sqrt(2 * pi())) as density
      from p cross join g join v {join.replace('using', 'using') if by else 'on true'} where h > 0
      group by {('p.' + by + ', ') if by else ''}g.point, lo, step, n, h)
select {g}point, round(x, 6) as x, round(density, 6) as density from d"""


@query("kde_score", _kde_sql("merged_fx", "score"))
def kde_score(spark, sf):
    return rounded(distribution.kde(fx.merged_fx(spark, sf), "score", 200), ["x", "density"])


@query("kde_length_by_score", _kde_sql("merged_fx", "review_length", 200, by="score"))
def kde_length_by_score(spark, sf):
    m = fx.merged_fx(spark, sf).where("score is not null")
    return rounded(distribution.kde(m, "review_length", 200, by=["score"]), ["x", "density"])


@query("length_by_score_box", """select score, count(review_length) as count, cast(min(review_length) as double) as min,
  quantile_cont(cast(review_length as double), 0.25) as q1, quantile_cont(cast(review_length as double), 0.5) as median,
  quantile_cont(cast(review_length as double), 0.75) as q3, cast(max(review_length) as double) as max
from merged_fx where score is not null and review_length is not null group by score""")
def length_by_score_box(spark, sf):
    return distribution.box_stats(fx.merged_fx(spark, sf), "score", "review_length")


@query("popularity_score_grid", """with v as (select ratings_count as x, score as y from merged_fx
  where ratings_count is not null and score is not null),
b as (select min(x) as x0a, max(x) as x1a, min(y) as y0a, max(y) as y1a from v),
e as (select case when x0a = x1a then x0a - 0.5 else x0a end as x0, case when x0a = x1a then x1a + 0.5 else x1a end as x1,
             case when y0a = y1a then y0a - 0.5 else y0a end as y0, case when y0a = y1a then y1a + 0.5 else y1a end as y1 from b)
select least(cast(floor((x - x0) / (x1 - x0) * 20) as integer), 19) as x_bin,
       least(cast(floor((y - y0) / (y1 - y0) * 20) as integer), 19) as y_bin, count(*) as count
from v, e group by 1, 2""")
def popularity_score_grid(spark, sf):
    return distribution.grid_density(fx.merged_fx(spark, sf), "ratings_count", "score", 20, 20)


_CAPPED = """(select case when u.avg_review_length > c.cap then c.cap else u.avg_review_length end as avg_review_length
  from (select user_id, avg(review_length) as avg_review_length from merged_fx group by user_id) u,
       (select quantile_cont(avg_review_length, 0.99) as cap from
          (select user_id, avg(review_length) as avg_review_length from merged_fx group by user_id)) c) uc"""


@query("hist_capped_length", _hist_sql(_CAPPED, "avg_review_length", 30))
def hist_capped_length(spark, sf):
    """Post-capping check: average review length per user, capped at its p99, in 30 bins."""
    from quire.operators import clean
    uf = clean.cap_upper(stats.user_features(fx.merged_fx(spark, sf)), "avg_review_length", 0.99)
    return rounded(distribution.histogram(uf, "avg_review_length", 30), ["lower", "upper"])
