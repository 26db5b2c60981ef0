"""Registered queries: sources, sinks, projections, cleaning, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import clean, layout, profile, report, stats
from quire.plans.registry import query, rounded
from quire.session import scratch_path
from quire.sources import fixtures as fx
from quire.sources import read_csv, read_parquet, read_table, write_csv, write_parquet

DOC_COLS = ["doc_id", "lang", "source", "text", "score"]


@query("src_csv_roundtrip", """select doc_id, lang, source, text, score from docs_fx""")
def src_csv_roundtrip(spark, sf):
    docs = fx.docs_fx(spark, sf).select(*DOC_COLS)
    path = write_csv(docs, scratch_path(spark, "csv"))
    return read_csv(spark, path, schema=docs.schema, multi_line=True)


@query("src_csv_split", """select review_id, user_id, item_id, score_raw, review_length from reviews_fx""")
def src_csv_split(spark, sf):
    """The default reader: files split over tasks, quotes checked."""
    rows = fx.reviews_fx(spark, sf).select("review_id", "user_id", "item_id", "score_raw", "review_length")
    path = write_csv(rows, scratch_path(spark, "csv"))
    return read_csv(spark, path, schema=rows.schema)


@query("src_csv_quoted_split", """select doc_id, lang, source, text, score from docs_fx""")
def src_csv_quoted_split(spark, sf):
    """Texts with line breaks, each file split over tasks."""
    docs = fx.docs_fx(spark, sf).select(*DOC_COLS)
    return read_csv(spark, write_csv(docs, scratch_path(spark, "csv")), schema=docs.schema, multi_line="split")


@query("cache_reuse", """with s as (select item_id, count(score) as c from merged_fx group by item_id)
select count(*) as items, cast(sum(c) as bigint) as reviews, max(c) as most,
  count(*) filter (where c = (select max(c) from s)) as items_at_most from s""")
def cache_reuse(spark, sf):
    """Counts per item, kept while two reports read them."""
    held = layout.cache(stats.item_stats(fx.merged_fx(spark, sf)))
    one = held.agg(F.count(F.lit(1)).alias("items"), F.sum("review_count").alias("reviews"), F.max("review_count").alias("most")).first()
    at = held.where(F.col("review_count") == one["most"]).count()
    held.unpersist()
    return spark.createDataFrame([(*one, at)], "items long, reviews long, most long, items_at_most long")


@query("src_parquet_scan", """select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity > 25""")
def src_parquet_scan(spark, sf):
    li = read_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])
    return li.where(F.col("l_quantity") > 25)


@query("sink_parquet_roundtrip", """select * from reviews_fx""")
def sink_parquet_roundtrip(spark, sf):
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))  # set to the size of the data
    path = write_parquet(fx.reviews_fx(spark, sf), scratch_path(spark, "parquet"), partitions=files)
    return spark.read.parquet(path)


@query("project_columns", """select review_id, user_id, score as "review/score", title from merged_fx""")
def project_columns(spark, sf):
    m = fx.merged_fx(spark, sf)
    return m.select("review_id", "user_id", F.col("score").alias("review/score"), "title")


@query("clean_drop_existing", """select review_id, user_id, item_id, score_raw, review_ts, review_length, title,
  categories, score, ratings_count from merged_fx""")
def clean_drop_existing(spark, sf):
    return clean.drop_existing(fx.merged_fx(spark, sf), ["review_time", "image", "authors", "infoLink"])


@query("clean_require_keys", """select review_id, item_id, title, score from merged_fx where title is not null""")
def clean_require_keys(spark, sf):
    return clean.require(fx.merged_fx(spark, sf).select("review_id", "item_id", "title", "score"), ["title"])


@query("clean_complete_cases", """select event_id, value from gap_fx where value is not null and not isnan(value)""")
def clean_complete_cases(spark, sf):
    return clean.complete_cases(fx.gap_fx(spark, sf), ["event_id", "value"])


@query("clean_safe_cast", """select review_id, score_raw, try_cast(score_raw as double) as score,
  try_cast(cast(review_time as string) as bigint) as review_time from reviews_fx""")
def clean_safe_cast(spark, sf):
    r = fx.reviews_fx(spark, sf).select("review_id", "score_raw", F.col("score_raw").alias("score"),
                                         F.col("review_time").cast("string").alias("review_time"))
    return clean.safe_cast(r, {"score": "double", "review_time": "bigint"})


@query("clean_fill_defaults", """select item_id, title, coalesce(authors, 'Unknown Author') as authors,
  coalesce(categories, 'Uncategorized') as categories,
  coalesce(try_cast(ratings_raw as int), 0) as ratings_count from books_fx""")
def clean_fill_defaults(spark, sf):
    b = fx.books_fx(spark, sf).select("item_id", "title", "authors", "categories",
                                      F.col("ratings_raw").try_cast("int").alias("ratings_count"))
    return clean.fill(b, {"authors": "Unknown Author", "categories": "Uncategorized", "ratings_count": 0})


@query("case_score_label", """select review_id, score,
  case when score >= 4 then 'positive' else 'negative' end as sentiment_label from merged_fx""")
def case_score_label(spark, sf):
    m = fx.merged_fx(spark, sf).select("review_id", "score")
    return m.withColumn("sentiment_label", clean.score_label("score"))


@query("case_score_label_nulls", """select review_id, score, case when score is null then null when score >= 4
  then 'positive' else 'negative' end as sentiment_label from merged_fx""")
def case_score_label_nulls(spark, sf):
    m = fx.merged_fx(spark, sf).select("review_id", "score")
    return m.withColumn("sentiment_label", clean.score_label("score", drop_null_label=True))


@query("outlier_bounds_disc", """select quantile_disc(ratings_count, 0.01) as lower,
  quantile_disc(ratings_count, 0.99) as upper from merged_fx""")
def outlier_bounds_disc(spark, sf):
    return clean.quantile_bounds(fx.merged_fx(spark, sf), "ratings_count", 0.01, 0.99)


@query("clean_winsorize", """with b as (select quantile_disc(ratings_count, 0.01) as lo,
  quantile_disc(ratings_count, 0.99) as hi from merged_fx)
select review_id, cast(case when ratings_count < lo then lo when ratings_count > hi then hi
  else ratings_count end as double) as ratings_count from merged_fx, b""")
def clean_winsorize(spark, sf):
    m = fx.merged_fx(spark, sf).select("review_id", "ratings_count")
    return clean.winsorize(m, "ratings_count", 0.01, 0.99)


@query("clean_clip", """select review_id, case when score < 2.0 then 2.0 when score > 4.0 then 4.0
  else score end as score from merged_fx""")
def clean_clip(spark, sf):
    return clean.clip(fx.merged_fx(spark, sf).select("review_id", "score"), "score", 2.0, 4.0)


@query("features_cap_p99", """with u as (select user_id, avg(score) as avg_review_score,
  count(score) as num_reviews, avg(review_length) as avg_review_length from merged_fx group by user_id),
c as (select quantile_cont(cast(num_reviews as double), 0.99) as c1,
  quantile_cont(avg_review_length, 0.99) as c2 from u)
select user_id, round(least(avg_review_score, 5.0), 6) as avg_review_score,
  round(case when num_reviews > c1 then c1 else num_reviews end, 6) as num_reviews,
  round(case when avg_review_length > c2 then c2 else avg_review_length end, 6) as avg_review_length
from u, c""")
def features_cap_p99(spark, sf):
    uf = stats.user_features(fx.merged_fx(spark, sf))
    uf = clean.clip(uf, "avg_review_score", 0.0, 5.0)
    uf = clean.cap_upper(uf, ["num_reviews", "avg_review_length"], 0.99)
    return rounded(uf, ["avg_review_score", "num_reviews", "avg_review_length"])


@query("features_caps", """with u as (select user_id, count(score) as num_reviews,
  avg(review_length) as avg_review_length from merged_fx group by user_id)
select round(quantile_cont(cast(num_reviews as double), 0.99), 6) as num_reviews_cap,
  round(quantile_cont(avg_review_length, 0.99), 6) as avg_review_length_cap from u""")
def features_caps(spark, sf):
    uf = stats.user_features(fx.merged_fx(spark, sf))
    caps = clean.upper_caps(uf, ["num_reviews", "avg_review_length"], 0.99)
    caps = caps.select(F.col("num_reviews").alias("num_reviews_cap"),
                       F.col("avg_review_length").alias("avg_review_length_cap"))
    return rounded(caps, ["num_reviews_cap", "avg_review_length_cap"])


@query("clean_dedupe", """select distinct user_id, item_id, score_raw from dup_fx""")
def clean_dedupe(spark, sf):
    return clean.dedupe(fx.dup_fx(spark, sf))


@query("clean_dedupe_report", """select count(*) as rows_before,
  (select count(*) from (select distinct * from dup_fx)) as rows_after,
  count(*) - (select count(*) from (select distinct * from dup_fx)) as rows_removed from dup_fx""")
def clean_dedupe_report(spark, sf):
    return clean.dedupe_report(fx.dup_fx(spark, sf))


@query("clean_dedupe_texts", """select count(*) as rows_before, count(distinct text) as rows_after,
  count(*) - count(distinct text) as rows_removed from documents""")
def clean_dedupe_texts(spark, sf):
    return clean.dedupe_report(read_table(spark, sf, "documents", ["text"]))


_OVERVIEW = {"item_id": "number", "title": "text", "authors": "text", "categories": "text", "ratings_raw": "text"}


def _overview_sql(c: str, kind: str) -> str:
    """The overview of one column of books_fx."""
    stat = lambda item, number, value="cast(null as varchar)", having="": (
        f"select '{c}' as \"column\", '{item}' as item, cast(null as integer) as rank, {value} as value, "
        f"cast({number} as double) as number from books_fx {having}")
    x = f"try_cast({c} as double)"
    ends = [stat(f, "null", f"cast({f}({c}) as varchar)", f"having count({c}) > 0") if kind == "text" else
            stat(f, f"{f}({c})", having=f"having count({c}) > 0") for f in ("min", "max")]
    return " union all ".join([
        stat("rows", "count(*)"), stat("missing", f"count(*) - count({c})"), stat("count", f"count({c})", having=f"having count({c}) > 0"),
        stat("mean", f"round(avg({x}), 6)", having=f"having count({x}) > 0"),
        stat("stddev", f"round(stddev_samp({x}), 6)", having=f"having count({x}) > 1"), *ends,
        f"select '{c}', 'top', cast(row_number() over (order by count(*) desc, cast({c} as varchar) nulls first) as integer) as r, cast({c} as varchar), "
        f"cast(count(*) as double) from books_fx group by {c} qualify r <= 5"])


@query("profile_overview", " union all ".join(_overview_sql(c, kind) for c, kind in _OVERVIEW.items()))
def profile_overview(spark, sf):
    """Missing counts, describe and top values of a table from one scan."""
    found = profile.overview(fx.books_fx(spark, sf), list(_OVERVIEW), k=5)
    return found.withColumn("number", F.round("number", 6))


@query("profile_missing", """select count(*) filter (where item_id is null) as item_id,
  count(*) filter (where title is null) as title, count(*) filter (where authors is null) as authors,
  count(*) filter (where categories is null) as categories,
  count(*) filter (where ratings_raw is null) as ratings_raw from books_fx""")
def profile_missing(spark, sf):
    return profile.missing(fx.books_fx(spark, sf))


@query("profile_missing_nan", """select count(*) filter (where event_id is null) as event_id,
  count(*) filter (where ts is null) as ts, count(*) filter (where user_id is null) as user_id,
  count(*) filter (where event_type is null) as event_type,
  count(*) filter (where value is null or isnan(value)) as value from gap_fx""")
def profile_missing_nan(spark, sf):
    return profile.missing(fx.gap_fx(spark, sf))


_DESC_COLS = ["title", "authors", "categories", "ratings_raw"]
_DESC_SQL = " union all\n".join(
    f"select '{c}' as \"column\", count({c}) as count, round(avg(try_cast({c} as double)), 6) as mean, "
    f"round(stddev_samp(try_cast({c} as double)), 6) as stddev, min({c}) as min, max({c}) as max from books_fx"
    for c in _DESC_COLS)


@query("profile_describe", _DESC_SQL)
def profile_describe(spark, sf):
    d = profile.describe(fx.books_fx(spark, sf), _DESC_COLS)
    return rounded(d, ["mean", "stddev"])


_SUM_COLS = ["score", "ratings_count", "review_length"]
_SUM_SQL = " union all\n".join(
    f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev, "
    f"cast(min({c}) as double) as min, cast(quantile_disc({c}, 0.25) as double) as p25, "
    f"cast(quantile_disc({c}, 0.5) as double) as p50, cast(quantile_disc({c}, 0.75) as double) as p75, "
    f"cast(max({c}) as double) as max from merged_fx"
    for c in _SUM_COLS)


@query("profile_summary", _SUM_SQL)
def profile_summary(spark, sf):
    return rounded(profile.summary(fx.merged_fx(spark, sf), _SUM_COLS), ["mean", "stddev"])


_TEXT_SQL = " union all\n".join(
    f"select '{c}' as \"column\", count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as stddev, min(v) as min, "
    f"quantile_disc(v, 0.25) as p25, quantile_disc(v, 0.5) as p50, quantile_disc(v, 0.75) as p75, max(v) as max "
    f"from (select try_cast({c} as double) as v from books_fx)" for c in ["title", "authors", "ratings_raw"])


@query("profile_summary_text", _TEXT_SQL)
def profile_summary_text(spark, sf):
    """Text columns: values that are no numbers are left out, a column without any keeps its row."""
    out = profile.summary(fx.books_fx(spark, sf), ["title", "authors", "ratings_raw"])
    return rounded(out, ["mean", "stddev"])


@query("quantiles_by_null_group", """select categories, p, cast(quantile_disc(ratings, 0.5) as double) as value from (
  select categories, 0.5::double as p, try_cast(ratings_raw as double) as ratings from books_fx)
where ratings is not null group by categories, p""")
def quantiles_by_null_group(spark, sf):
    from quire.operators.quantile import quantiles_long
    b = fx.books_fx(spark, sf).select("categories", F.col("ratings_raw").try_cast("double").alias("ratings"))
    return quantiles_long(b.where("ratings is not null"), "ratings", [0.5], by=["categories"]).select("categories", "p", "value")


@query("profile_summary_approx")
def profile_summary_approx(spark, sf):
    """Same table with approximate percentiles (one pass, bounded sketches)."""
    return profile.summary(fx.merged_fx(spark, sf), _SUM_COLS, exact=False)


@query("profile_row_count", """select (select count(*) from reviews_fx) as reviews,
  (select count(*) from books_fx) as books, (select count(*) from merged_fx) as merged,
  (select count(*) from docs_fx) as docs""")
def profile_row_count(spark, sf):
    parts = {"reviews": fx.reviews_fx, "books": fx.books_fx, "merged": fx.merged_fx, "docs": fx.docs_fx}
    first, *rest = list(parts)
    out = profile.row_count(parts[first](spark, sf), first)
    cols = [profile.row_count(parts[n](spark, sf), n).scalar().alias(n) for n in rest]
    return out.select("*", *cols)


@query("profile_head", """select item_id, title, authors, categories, ratings_raw from books_fx
order by item_id limit 5""")
def profile_head(spark, sf):
    return profile.head(fx.books_fx(spark, sf), ["item_id", "title", "authors", "categories", "ratings_raw"],
                        5, ["item_id"])


@query("report_long_form", """with m as (select count(*) filter (where title is null) as title,
  count(*) filter (where categories is null) as categories, count(*) filter (where ratings_raw is null) as ratings_raw
  from books_fx),
t as (select categories, count(*) as count from books_fx group by categories
  order by count desc, categories asc nulls first limit 3),
tn as (select row_number() over (order by count desc, categories asc nulls first) as row_no, * from t)
select 'missing' as section, cast(1 as bigint) as row_no, 'title' as key, cast(title as varchar) as value from m
union all select 'missing', 1, 'categories', cast(categories as varchar) from m
union all select 'missing', 1, 'ratings_raw', cast(ratings_raw as varchar) from m
union all select 'top_categories', row_no, 'categories', categories from tn
union all select 'top_categories', row_no, 'count', cast(count as varchar) from tn""")
def report_long_form(spark, sf):
    from quire.operators import topk
    b = fx.books_fx(spark, sf)
    miss = profile.missing(b, ["title", "categories", "ratings_raw"])
    top = topk.frequent(b, "categories", 3)
    return report.combine(
        report.section("missing", miss, [F.lit(1)]),
        report.section("top_categories", top, [F.col("count").desc(), F.col("categories").asc_nulls_first()]),
    )


_SCHEMA = {"review_id": "bigint", "user_id": "bigint", "item_id": "bigint", "score_raw": "string", "review_time": "bigint",
           "review_ts": "timestamp_ntz", "review_length": "int", "title": "string", "authors": "string",
           "categories": "string", "score": "double", "ratings_count": "double"}
_SCHEMA_SQL = " union all\n".join(
    f"select cast({i} as integer) as position, '{c}' as \"column\", '{t}' as type, "
    f"count(*) filter (where {c} is null{' or isnan(' + c + ')' if t == 'double' else ''}) as nulls from merged_fx"
    for i, (c, t) in enumerate(_SCHEMA.items()))


@query("report_schema", _SCHEMA_SQL)
def report_schema(spark, sf):
    return report.schema_table(spark, fx.merged_fx(spark, sf), with_nulls=True).drop("nullable")


@query("stream_csv_ingest", """select doc_id, lang, source, text, score from docs_fx""")
def stream_csv_ingest(spark, sf):
    from quire.streaming import ingest_csv_stream
    docs = fx.docs_fx(spark, sf).select(*DOC_COLS)
    landing = write_csv(docs, scratch_path(spark, "landing"))
    out = scratch_path(spark, "ingested")
    ingest_csv_stream(spark, landing, docs.schema, out)
    return spark.read.schema(docs.schema).parquet(out)


@query("clean_items_fx", """with b as (select item_id, title, coalesce(authors, 'Unknown Author') as authors,
  coalesce(categories, 'Uncategorized') as categories, coalesce(try_cast(ratings_raw as int), 0) as ratings_raw
  from books_fx where title is not null),
q as (select quantile_disc(ratings_raw, 0.01) as lo, quantile_disc(ratings_raw, 0.99) as hi from b)
select distinct item_id, title, authors, categories,
  cast(case when ratings_raw < lo then lo when ratings_raw > hi then hi else ratings_raw end as double) as ratings_raw
from b, q""")
def clean_items_fx(spark, sf):
    return clean.clean_items(fx.books_fx(spark, sf), key="title", count_col="ratings_raw")


@query("clean_reviews_fx", """select distinct review_id, user_id, item_id, coalesce(score_raw, 'No Score') as score_raw,
  review_time, review_length, strftime(make_timestamp(review_time * 1000000), '%Y-%m-%d %H:%M:%S') as review_time_text
from reviews_fx where item_id is not null and user_id is not null""")
def clean_reviews_fx(spark, sf):
    return clean.clean_reviews(fx.reviews_fx(spark, sf), keys=["item_id", "user_id"], drop=["review_ts", "Price"],
                               time_col="review_time", defaults={"score_raw": "No Score"})


@query("merged_features_fx", """select r.review_id, r.item_id, b.title, try_cast(r.score_raw as double) as score_raw,
  cast(try_cast(b.ratings_raw as int) as double) as ratings_raw,
  cast(year(make_timestamp(r.review_time * 1000000)) as integer) as review_year
from reviews_fx r left join books_fx b on r.item_id = b.item_id""")
def merged_features_fx(spark, sf):
    from quire.operators import enrich
    r = fx.reviews_fx(spark, sf).select("review_id", "item_id", "score_raw", "review_time")
    b = fx.books_fx(spark, sf).select("item_id", "title", F.col("ratings_raw").try_cast("int").alias("ratings_raw"))
    m = enrich.merged_features(r, b, "item_id", score="score_raw", count="ratings_raw", time_col="review_time",
                               drop=["review_time"])
    return m.select("review_id", "item_id", "title", "score_raw", "ratings_raw", "review_year")
