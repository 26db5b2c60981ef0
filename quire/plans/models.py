"""Registered queries: segmentation, classification, regression, recommendation."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from quire.ml import cluster, features, recommend, supervised
from quire.operators import clean, distribution, sampling, stats, text
from quire.operators.layout import stage_table
from quire.plans.params import LEXICON, STOPWORDS as ML_STOPWORDS, TRAIN_SEED
from quire.plans.registry import query, rounded
from quire.plans.samples import _bucket_sql
from quire.plans.texts import _POLARITY_SQL, _tok
from quire.session import scratch_path
from quire.sources import fixtures as fx
from quire.sources import load_model, save_model

FEAT = ["avg_review_score", "num_reviews", "avg_review_length"]
# Centres (in standardised units) for the nearest-centre queries.
CENTERS = [[0.8, -0.3, -0.5], [-1.2, 0.0, 0.2], [0.1, 1.5, 0.3], [0.0, -0.2, 1.4]]
TRAIN_CUT = round(0.8 * sampling.HASH_MODULUS)


def _sided_reviews(spark, sf):
    """The reviews and whether ``sampling.split`` by review_id puts them into the first four fifths (null without an id): the
    side goes through the joins of the regression and the recommender in place of the id."""
    return fx.reviews_fx(spark, sf).withColumn("train", sampling.stable_bucket("review_id", TRAIN_SEED) < TRAIN_CUT)


def _shared_reviews(spark, sf):
    """What the regression and the recommender need of the reviews, written once for the queries that fit both."""
    return stage_table(_sided_reviews(spark, sf).select("train", "user_id", "item_id", "score_raw", "review_length"), "reviews", "zstd")


def _users(spark, sf):
    return clean.complete_cases(stats.user_features(fx.merged_fx(spark, sf)), ["user_id", *FEAT])


def _zusers(spark, sf):
    return features.standardize(_users(spark, sf), FEAT, suffix="_z")


_USERS_SQL = """with u as (select user_id, avg(score) as avg_review_score, cast(count(score) as double) as num_reviews,
  avg(review_length) as avg_review_length from merged_fx group by user_id),
uc as (select * from u where avg_review_score is not null and avg_review_length is not null),
st as (select avg(avg_review_score) as m1, stddev_pop(avg_review_score) as s1, avg(num_reviews) as m2,
  stddev_pop(num_reviews) as s2, avg(avg_review_length) as m3, stddev_pop(avg_review_length) as s3 from uc),
z as (select uc.*, (avg_review_score - m1) / (case when s1 = 0 or s1 is null then 1 else s1 end) as z1,
  (num_reviews - m2) / (case when s2 = 0 or s2 is null then 1 else s2 end) as z2,
  (avg_review_length - m3) / (case when s3 = 0 or s3 is null then 1 else s3 end) as z3 from uc, st)"""


def _dist_sql(c: list[float]) -> str:
    return "0.0 + " + " + ".join(f"(z{i + 1} - ({x})) * (z{i + 1} - ({x}))" for i, x in enumerate(c))


_ASSIGN_SQL = _USERS_SQL + """,
d as (select *, """ + ", ".join(f"{_dist_sql(c)} as d{j}" for j, c in enumerate(CENTERS)) + """ from z),
a as (select *, case when d0 <= d1 and d0 <= d2 and d0 <= d3 then 0 when d1 <= d2 and d1 <= d3 then 1
  when d2 <= d3 then 2 else 3 end as cluster from d)"""


def _assigned(spark, sf):
    return cluster.assign(_zusers(spark, sf), [f + "_z" for f in FEAT], CENTERS)


@query("standardize_features", _USERS_SQL + """
select user_id, round(z1, 6) as avg_review_score_z, round(z2, 6) as num_reviews_z, round(z3, 6) as avg_review_length_z from z""")
def standardize_features(spark, sf):
    z = _zusers(spark, sf)
    return rounded(z.select("user_id", *[f + "_z" for f in FEAT]), [f + "_z" for f in FEAT])


@query("nearest_center", _ASSIGN_SQL + "\nselect user_id, cast(cluster as integer) as cluster from a")
def nearest_center(spark, sf):
    return _assigned(spark, sf).select("user_id", "cluster")


@query("cluster_sizes", _ASSIGN_SQL + "\nselect cast(cluster as integer) as cluster, count(*) as num_users from a group by cluster")
def cluster_sizes(spark, sf):
    return cluster.cluster_sizes(_assigned(spark, sf))


@query("cluster_profile", _ASSIGN_SQL + """
select cast(cluster as integer) as cluster, round(avg(avg_review_score), 6) as avg_review_score,
  round(avg(num_reviews), 6) as num_reviews, round(avg(avg_review_length), 6) as avg_review_length,
  count(*) as num_users from a group by cluster""")
def cluster_profile(spark, sf):
    return cluster.cluster_profile(_assigned(spark, sf), FEAT, digits=6)


@query("reader_segments")
def reader_segments(spark, sf):
    _, seg = cluster.segment(_users(spark, sf), FEAT, "user_id", k=4, seed=TRAIN_SEED)
    return seg.select("user_id", *FEAT, "cluster")


@query("reader_segment_sizes")
def reader_segment_sizes(spark, sf):
    _, seg = cluster.segment(_users(spark, sf), FEAT, "user_id", k=4, seed=TRAIN_SEED)
    return cluster.cluster_profile(seg, FEAT, digits=2)


@query("elbow_wcss")
def elbow_wcss(spark, sf):
    return cluster.elbow(_users(spark, sf), FEAT, "user_id", list(range(2, 8)), seed=TRAIN_SEED)


@query("pca_two_column_variance", """with c as (select corr(score, cast(review_length as double)) as r from merged_fx
  where score is not null and review_length is not null)
select 'PC1' as component, round((1 + abs(r)) / 2, 6) as explained_variance from c
union all select 'PC2', round((1 - abs(r)) / 2, 6) from c""")
def pca_two_column_variance(spark, sf):
    m = clean.complete_cases(fx.merged_fx(spark, sf), ["review_id", "score", "review_length"])
    ratios, _ = cluster.pca(m, ["score", "review_length"], k=2)
    return rounded(cluster.variance_table(spark, ratios), ["explained_variance"])


@query("pca_scores")
def pca_scores(spark, sf):
    _, scores = cluster.pca(_users(spark, sf), FEAT, k=2)
    return scores.select("user_id", "PC1", "PC2")


def _cluster_points(spark, sf):
    """(user_id, PC1, PC2, cluster): the features are prepared once for the segments and the components."""
    _, seg = cluster.segment(_users(spark, sf), FEAT, "user_id", k=4, seed=TRAIN_SEED)
    _, points = cluster.pca(seg, FEAT, k=2)
    return points.select("user_id", "PC1", "PC2", "cluster")


@query("pca_cluster_grid")
def pca_cluster_grid(spark, sf):
    points = stage_table(_cluster_points(spark, sf), "points")  # read by the bounds subqueries and the grid
    return distribution.grid_density(points, "PC1", "PC2", 20, 20, by=["cluster"])


@query("pca_cluster_table")
def pca_cluster_table(spark, sf):
    """(user_id, PC1, PC2, cluster): the points behind the cluster scatter."""
    return _cluster_points(spark, sf)


@query("pca_review_metrics")
def pca_review_metrics(spark, sf):
    cols = ["score", "ratings_count", "review_length"]
    m = clean.complete_cases(fx.merged_fx(spark, sf), ["review_id", *cols])
    _, scores = cluster.pca(m, cols, k=2)
    return scores.select("review_id", "PC1", "PC2")


# ---- classification -------------------------------------------------------

def _labelled_docs(spark, sf):
    d = fx.docs_fx(spark, sf).where(F.col("text").isNotNull() & F.col("score").isNotNull())
    d = d.withColumn("sentiment_label", clean.score_label("score"))
    return stage_table(d, "labelled", "zstd")  # every fitting stage reads it


def _doc_split(spark, sf):
    d = _labelled_docs(spark, sf)
    return sampling.split(d, [0.8, 0.2], TRAIN_SEED, key="doc_id")


@query("sentiment_model_accuracy")
def sentiment_model_accuracy(spark, sf):
    train, test = _doc_split(spark, sf)
    model = supervised.sentiment_classifier(train, "text", "sentiment_label")
    pred = model.transform(test)
    return supervised.accuracy_table(pred)


@query("ml_model_roundtrip")
def ml_model_roundtrip(spark, sf):
    train, test = _doc_split(spark, sf)
    model = supervised.sentiment_classifier(train, "text", "sentiment_label")
    path = save_model(model, scratch_path(spark, "model"))
    again = load_model(PipelineModel, path)
    return again.transform(test).select("doc_id", "prediction")


_ML_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ML_STOPWORDS) + "]"


@query("nlp_features", f"""with d as (select doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text),
  '[ \\t\\n\\r\\f\\x0B]+$', ''), '[ \\t\\n\\r\\f\\x0B]'), lambda t: not list_contains({_ML_STOP}, t)) as words
  from docs_fx where text is not null)
select doc_id, cast(len(words) as integer) as num_tokens, cast(len(list_distinct(words)) as integer) as num_terms,
  cast(len(words) as double) as sum_frequencies from d""")
def nlp_features(spark, sf):
    from pyspark.ml import Pipeline
    docs = fx.docs_fx(spark, sf).where(F.col("text").isNotNull())
    stages = supervised.text_features_stages("text", stopwords=ML_STOPWORDS)[:3]
    out = Pipeline(stages=stages).fit(docs).transform(docs)
    # the hashed frequencies are read from the sparse vectors, never densified
    hashed = F.unwrap_udt("raw_features")["values"]
    return out.select("doc_id", F.size("filtered_tokens").alias("num_tokens"),
                      F.size(F.array_distinct("filtered_tokens")).alias("num_terms"),
                      F.aggregate(hashed, F.lit(0.0), lambda a, x: a + x).alias("sum_frequencies"))


@query("accuracy_from_predictions", _POLARITY_SQL + """,
j as (select case when f.score >= 4 then 'positive' else 'negative' end as label,
  case when lab.polarity > 0 then 'positive' else 'negative' end as prediction
  from lab join docs_fx f on lab.doc_id = f.doc_id where f.score is not null)
select count(*) as n, cast(sum(case when label = prediction then 1 else 0 end) as bigint) as correct,
  round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as accuracy from j""")
def accuracy_from_predictions(spark, sf):
    d = fx.docs_fx(spark, sf).where(F.col("text").isNotNull() & F.col("score").isNotNull())
    lex = spark.createDataFrame(LEXICON, "word string, polarity double")
    p = text.polarity(d, "text", lex, keep_text=False)
    p = p.select(clean.score_label("score").alias("label"),
                 F.when(F.col("polarity") > 0, "positive").otherwise("negative").alias("prediction"))
    return rounded(supervised.accuracy_table(p), ["accuracy"])


@query("idf_weights", f"""with d as (select text from docs_fx where text is not null),
n as (select count(*) as n from d),
w as (select unnest(list_distinct({_tok('text')})) as word from d),
f as (select word, count(*) as doc_freq from w group by word)
select word, doc_freq, round(ln((n + 1.0) / (doc_freq + 1)), 6) as idf from f, n""")
def idf_weights(spark, sf):
    return rounded(supervised.idf_weights(fx.docs_fx(spark, sf), "text"), ["idf"])


# ---- regression -----------------------------------------------------------

REG_FEATURES = ["ratings_count", "review_length"]
_SPLIT = _bucket_sql("review_id", TRAIN_SEED)
_REG_SQL = f"""with t as (select score as y, ratings_count as x1, cast(review_length as double) as x2 from merged_fx
  where {_SPLIT} < {TRAIN_CUT} and score is not null and ratings_count is not null and review_length is not null),
s as (select avg(y) as my, avg(x1) as m1, avg(x2) as m2, covar_pop(x1, x1) as s11, covar_pop(x2, x2) as s22,
  covar_pop(x1, x2) as s12, covar_pop(x1, y) as s1y, covar_pop(x2, y) as s2y from t),
b as (select (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) as b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) as b2,
  my, m1, m2 from s),
c as (select my - b1 * m1 - b2 * m2 as b0, b1, b2 from b)"""


def _reg_split(spark, sf, reviews=None):
    """Train and test rows, written once: Spark ML reads the train rows several times (the fit, then its summary)."""
    reviews = _sided_reviews(spark, sf) if reviews is None else reviews
    m = clean.complete_cases(fx.merged_with(spark, sf, reviews), ["train", "score", *REG_FEATURES])
    m = stage_table(m, "regression", "zstd")
    return m.where("train").drop("train"), m.where("not train").drop("train")


@query("ols_coefficients", _REG_SQL + """
select round(b0, 6) as intercept, round(b1, 6) as coef_ratings_count, round(b2, 6) as coef_review_length from c""")
def ols_coefficients(spark, sf):
    train, _ = _reg_split(spark, sf)
    model = supervised.score_regression(train, REG_FEATURES, "score")
    rows = [(float(model.intercept), float(model.coefficients[0]), float(model.coefficients[1]))]
    out = spark.createDataFrame(rows, "intercept double, coef_ratings_count double, coef_review_length double")
    return rounded(out, ["intercept", "coef_ratings_count", "coef_review_length"])


@query("regression_rmse_r2", _REG_SQL + f""",
e as (select score as y, score - (b0 + b1 * ratings_count + b2 * review_length) as err from merged_fx, c
  where {_SPLIT} >= {TRAIN_CUT} and score is not null and ratings_count is not null and review_length is not null),
my as (select avg(y) as m from e)
select count(*) as n, round(sqrt(avg(err * err)), 6) as rmse,
  round(1 - sum(err * err) / sum((y - m) * (y - m)), 6) as r2 from e, my""")
def regression_rmse_r2(spark, sf):
    return _regression_error(spark, sf)


def _regression_error(spark, sf, reviews=None):
    train, test = _reg_split(spark, sf, reviews)
    model = supervised.score_regression(train, REG_FEATURES, "score")
    return rounded(supervised.regression_metrics(model, test, REG_FEATURES, "score"), ["rmse", "r2"])


# ---- recommendation -------------------------------------------------------

_INDEX_SQL = """u as (select user_id, cast(row_number() over (order by count(*) desc, user_id asc) - 1 as double) as user_index
  from merged_fx where user_id is not null group by user_id),
i as (select item_id, cast(row_number() over (order by count(*) desc, item_id asc) - 1 as double) as item_index
  from merged_fx where item_id is not null group by item_id)"""


@query("string_index", "with " + _INDEX_SQL + " select user_id, user_index from u")
def string_index(spark, sf):
    return features.index_labels(fx.merged_fx(spark, sf), "user_id", "user_index")


@query("ratings_matrix", "with " + _INDEX_SQL + """
select u.user_index, i.item_index, m.score as rating, m.review_id from merged_fx m
join u on m.user_id = u.user_id join i on m.item_id = i.item_id where m.score is not null""")
def ratings_matrix(spark, sf):
    r, _, _ = recommend.ratings(fx.rated_fx(spark, sf), "user_id", "item_id", "score", keep=["review_id"])
    return r


def _als_split(spark, sf, reviews=None, keep=()):
    """Train and test rows and the label tables. The rows are written once, the indices as integers, which ALS asks for:
    the fit reads the train rows, the evaluation the test rows. The review id only comes along if ``keep`` names it."""
    kept = [*keep, "train"]
    rated = fx.rated_with(spark, sf, _sided_reviews(spark, sf) if reviews is None else reviews, kept)
    r, users, items = recommend.ratings(rated, "user_id", "item_id", "score", keep=kept)
    index = ["user_index", "item_index"]
    r = stage_table(r.withColumns({c: F.col(c).cast("int") for c in index}), "ratings", "zstd")
    r = r.withColumns({c: F.col(c).cast("double") for c in index})
    return r.where("train").drop("train"), r.where("not train").drop("train"), users, items


@query("als_predictions")
def als_predictions(spark, sf):
    train, test, _, _ = _als_split(spark, sf, keep=["review_id"])
    model = recommend.als(train, seed=TRAIN_SEED)
    return model.transform(test).select("review_id", "user_index", "item_index", "rating", "prediction")


@query("als_rmse")
def als_rmse(spark, sf):
    return _als_error(spark, sf)


def _als_error(spark, sf, reviews=None):
    train, test, _, _ = _als_split(spark, sf, reviews)
    model = recommend.als(train, seed=TRAIN_SEED)
    pred = model.transform(test)
    err = F.col("rating") - F.col("prediction")
    return pred.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))


@query("als_top5")
def als_top5(spark, sf):
    train, _, users, items = _als_split(spark, sf)
    model = recommend.als(train, seed=TRAIN_SEED)
    return recommend.recommend_top(model, 5, users, items, "user_id", "item_id")


@query("cold_start_pairs", f"""with r as (select review_id, user_id, item_id from merged_fx
  where user_id is not null and item_id is not null and score is not null),
tr as (select * from r where {_SPLIT} < {TRAIN_CUT}), te as (select * from r where {_SPLIT} >= {TRAIN_CUT})
select distinct review_id, user_id, item_id from te
where user_id not in (select user_id from tr) or item_id not in (select item_id from tr)""")
def cold_start_pairs(spark, sf):
    r = fx.merged_fx(spark, sf).where("user_id is not null and item_id is not null and score is not null")
    r = r.select("review_id", "user_id", "item_id")
    train, test = sampling.split(r, [0.8, 0.2], TRAIN_SEED, key="review_id")
    return recommend.cold_start_pairs(train, test, "user_id", "item_id")


@query("model_metrics")
def model_metrics(spark, sf):
    """Evaluation results of the three supervised models as (model, metric, value) rows."""
    from quire.operators import report
    reviews = _shared_reviews(spark, sf)
    reg = _regression_error(spark, sf, reviews).first()
    acc = sentiment_model_accuracy(spark, sf).first()
    als_r = _als_error(spark, sf, reviews).first()
    return report.combine(
        report.metrics(spark, "score_regression", {"rmse": reg["rmse"], "r2": reg["r2"]}),
        report.metrics(spark, "sentiment_classifier", {"accuracy": acc["accuracy"]}),
        report.metrics(spark, "als", {"rmse": als_r["rmse"]}),
    )
