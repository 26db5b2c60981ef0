"""Judged companions of the model and sampling queries.

A fitted model's numbers cannot be written in SQL, but what must hold for them can: every user in one segment, the
sum of squares split between and within segments, uncorrelated components with the variances the correlation matrix
demands, predictions for all but cold-start pairs, saved models that predict the same. The Spark side computes each
from the fitted model, the SQL side from the tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.ml import cluster, recommend, supervised
from quire.ml.features import assemble
from quire.operators import clean, profile, report, sampling
from quire.operators.layout import stage_table
from quire.plans import models as M
from quire.plans.cleaning import _SUM_COLS
from quire.plans.params import TRAIN_SEED
from quire.plans.registry import query, rounded
from quire.plans.samples import _bucket_sql
from quire.session import scratch_path
from quire.sources import fixtures as fx
from quire.sources import load_model, save_model

_Z = [c + "_z" for c in M.FEAT]


def _squares(centers) -> Column:
    """Smallest squared distance of the standardised features to the given centres."""
    d = [sum(((F.col(c) - float(x)) * (F.col(c) - float(x)) for c, x in zip(_Z, p)), F.lit(0.0)) for p in centers]
    return F.array_min(F.array(*d))


@query("segment_checks", M._USERS_SQL + """
select count(*) as users, count(distinct user_id) as distinct_users, cast(4 as bigint) as segments,
  cast(0 as bigint) as not_nearest from z""")
def segment_checks(spark, sf):
    model, seg = cluster.segment(M._users(spark, sf), M.FEAT, "user_id", k=4, seed=TRAIN_SEED)
    centers = model.clusterCenters()
    own = F.coalesce(*[F.when(F.col("cluster") == i, _squares([c])) for i, c in enumerate(centers)])
    return seg.agg(F.count(F.lit(1)).alias("users"), F.count_distinct("user_id").alias("distinct_users"),
                   F.count_distinct("cluster").alias("segments"),
                   F.count(F.when(own.isNull() | (own > _squares(centers) + 1e-9), 1)).alias("not_nearest"))


@query("elbow_checks", M._USERS_SQL + """,
t as (select count(*) as users, sum(z1 * z1 + z2 * z2 + z3 * z3) as total from z)
select k, users, round(total, 3) as total_squares, true as within_total, true as falls
from t, (values (2), (3), (4), (5), (6), (7)) v(k)""")
def elbow_checks(spark, sf):
    users = stage_table(M._zusers(spark, sf), "elbow")
    costs = {r["k"]: r["wcss"] for r in cluster.elbow(users.drop(*_Z), M.FEAT, "user_id", list(range(2, 8)), seed=TRAIN_SEED)
             .collect()}  # one row per k
    total = users.agg(F.count(F.lit(1)).alias("users"), F.round(F.sum(_squares([[0.0] * 3])), 3).alias("total_squares"))
    # random starts: a larger k may end a little higher, by at most a twentieth
    rows = [(k, w, all(w <= 1.05 * before for j, before in costs.items() if j < k)) for k, w in costs.items()]
    total = total.withColumn("_k", F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("wcss"), F.lit(ok).alias("falls"))
                                             for k, w, ok in rows]))
    return total.select("users", "total_squares", F.inline("_k")).select(
        "k", "users", "total_squares", (F.col("wcss") < F.col("total_squares")).alias("within_total"), "falls")


def _eigen_sql(name: str, source: str, cols: list[str]) -> str:
    """Closed-form eigenvalues of the correlation matrix of three columns."""
    a, b, c = cols
    return f"""{name}_r as (select count(*) as n, corr({a}, {b}) as x, corr({a}, {c}) as y, corr({b}, {c}) as w from {source}),
{name}_p as (select *, sqrt((x * x + y * y + w * w) / 3) as p from {name}_r),
{name}_t as (select *, acos(greatest(-1.0, least(1.0, x * y * w / (p * p * p)))) / 3 as t from {name}_p),
{name} as (select n, 1 + 2 * p * cos(t) as l1, 1 - 2 * p * cos(t) - 2 * p * cos(t + 2 * pi() / 3) as l2 from {name}_t)"""


def _pca_rows(name: str, source: str, cols: list[str]) -> str:
    return f"""select '{name}' as data, n as rows, round(l1, 5) as var_1, round(l2, 5) as var_2, round(l1 / 3, 5) as ratio_1,
  round(l2 / 3, 5) as ratio_2, true as centred, true as uncorrelated from {source}"""


@query("pca_checks", M._USERS_SQL + """,
m as (select score, ratings_count, cast(review_length as double) as review_length from merged_fx
  where score is not null and ratings_count is not null and review_length is not null),
""" + _eigen_sql("eu", "uc", M.FEAT) + ",\n" + _eigen_sql("em", "m", ["score", "ratings_count", "review_length"]) + "\n"
       + _pca_rows("users", "eu", M.FEAT) + " union all " + _pca_rows("reviews", "em", []))
def pca_checks(spark, sf):
    def checked(name, df, cols):
        ratios, scores = cluster.pca(df, cols, k=2)
        one = scores.agg(F.count(F.lit(1)).alias("rows"), F.round(F.var_pop("PC1"), 5).alias("var_1"),
                         F.round(F.var_pop("PC2"), 5).alias("var_2"),
                         ((F.abs(F.avg("PC1")) < 1e-6) & (F.abs(F.avg("PC2")) < 1e-6)).alias("centred"),
                         (F.abs(F.covar_pop("PC1", "PC2")) < 1e-6).alias("uncorrelated"))
        return one.select(F.lit(name).alias("data"), "rows", "var_1", "var_2", F.round(F.lit(ratios[0]), 5).alias("ratio_1"),
                          F.round(F.lit(ratios[1]), 5).alias("ratio_2"), "centred", "uncorrelated")

    return checked("users", M._users(spark, sf), M.FEAT).unionByName(
        checked("reviews", fx.merged_fx(spark, sf), ["score", "ratings_count", "review_length"]))


@query("pca_cluster_checks", M._USERS_SQL + """
select count(*) as users, count(distinct user_id) as distinct_users, cast(0 as bigint) as incomplete, count(*) as in_grid from z""")
def pca_cluster_checks(spark, sf):
    grid = M.pca_cluster_grid(spark, sf).agg(F.sum("count").cast("bigint").alias("n"))
    bad = F.col("PC1").isNull() | F.col("PC2").isNull() | F.col("cluster").isNull()
    return M._cluster_points(spark, sf).agg(
        F.count(F.lit(1)).alias("users"), F.count_distinct("user_id").alias("distinct_users"),
        F.count(F.when(bad, 1)).alias("incomplete")).withColumn("in_grid", grid.scalar())


_DOC_TEST = f"""td as (select case when score >= 4 then 'positive' else 'negative' end as label from docs_fx
  where text is not null and score is not null and {_bucket_sql('doc_id', TRAIN_SEED)} >= {M.TRAIN_CUT})"""


@query("classifier_checks", "with " + _DOC_TEST + """
select count(*) as n_test, greatest(count(*) filter (where label = 'positive'), count(*) filter (where label = 'negative'))
  as majority, true as reaches_majority from td""")
def classifier_checks(spark, sf):
    """Right at least as often as the larger label; needs more than a handful of labelled documents."""
    train, test = M._doc_split(spark, sf)
    scored = supervised.sentiment_classifier(train, "text", "sentiment_label").transform(test)
    one = scored.agg(F.count(F.lit(1)).alias("n_test"),
                     F.greatest(F.count(F.when(F.col("sentiment_label") == "positive", 1)),
                                F.count(F.when(F.col("sentiment_label") == "negative", 1))).alias("majority"),
                     F.count(F.when(F.col("prediction") == F.col("label"), 1)).alias("correct"))
    return one.select("n_test", "majority", (F.col("correct") >= F.col("majority")).alias("reaches_majority"))


_RATED = f"""r as (select review_id, user_id, item_id, {_bucket_sql('review_id', TRAIN_SEED)} < {M.TRAIN_CUT} as train
  from merged_fx where user_id is not null and item_id is not null and score is not null),
warm as (select * from r where not train and user_id in (select user_id from r where train)
  and item_id in (select item_id from r where train))"""
_REG_TEST = f"""rt as (select review_id from merged_fx where {_bucket_sql('review_id', TRAIN_SEED)} >= {M.TRAIN_CUT}
  and score is not null and ratings_count is not null and review_length is not null)"""


@query("model_roundtrip_checks", f"""with {_DOC_TEST}, {_RATED}, {_REG_TEST}
select 'classifier' as model, (select count(*) from td) as predictions, cast(0 as bigint) as differing
union all select 'regression', (select count(*) from rt), 0
union all select 'als', (select count(*) from warm), 0""")
def model_roundtrip_checks(spark, sf):
    """Each model is saved and loaded; both must predict the same for every test row."""
    def compared(name, model, kind, test):
        again = load_model(kind, save_model(model, scratch_path(spark, f"model-{name}")))
        both = again.transform(model.transform(test).select(*test.columns, F.col("prediction").alias("_before")))
        return both.agg(F.lit(name).alias("model"), F.count("prediction").alias("predictions"),
                        F.count(F.when(~F.col("_before").eqNullSafe(F.col("prediction")), 1)).alias("differing"))

    train, test = M._doc_split(spark, sf)
    out = compared("classifier", supervised.sentiment_classifier(train, "text", "sentiment_label"), PipelineModel, test)
    reviews = M._shared_reviews(spark, sf)
    train, test = M._reg_split(spark, sf, reviews)
    linear = supervised.score_regression(train, M.REG_FEATURES, "score")
    out = out.unionByName(compared("regression", linear, LinearRegressionModel, assemble(test, M.REG_FEATURES)))
    train, test, _, _ = M._als_split(spark, sf, reviews)
    return out.unionByName(compared("als", recommend.als(train, seed=TRAIN_SEED), ALSModel, test))


@query("als_checks", f"""with {_RATED},
u as (select count(distinct user_id) as n from r where train)
select (select count(*) from warm) as predictions, cast(0 as bigint) as negative, u.n as users, u.n * 5 as recommended,
  cast(0 as bigint) as wrong_ranks, cast(0 as bigint) as repeated from u""")
def als_checks(spark, sf):
    """All but cold-start pairs get a prediction, none negative; each trained user gets five different items."""
    train, test, users, items = M._als_split(spark, sf)
    model = recommend.als(train, seed=TRAIN_SEED)
    pred = model.transform(test).agg(F.count(F.lit(1)).alias("predictions"),
                                     F.count(F.when(F.col("prediction") < 0, 1)).alias("negative"))
    top = recommend.recommend_for_all(model, 5, users, items, "user_id", "item_id")
    per = top.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_id").alias("items"),
                                     F.array_sort(F.collect_set("rank")).alias("ranks"))  # five rows a user
    per = per.agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("recommended"),
                  F.count(F.when(F.col("ranks") != F.array(*[F.lit(i) for i in range(1, 6)]), 1)).alias("wrong_ranks"),
                  F.count(F.when(F.col("items") != F.col("n"), 1)).alias("repeated"))
    per = stage_table(per, "recommended")
    return pred.withColumns({c: per.select(c).scalar() for c in per.columns})


@query("als_top5_checks", f"""with {_RATED},
u as (select count(distinct user_id) as n from r where train)
select u.n as users, u.n * 5 as recommended, cast(0 as bigint) as differing from u""")
def als_top5_checks(spark, sf):
    """The pruned search gives each user the scores, rank by rank, that the full product of all users and items gives."""
    train, _, users, items = M._als_split(spark, sf)
    model = recommend.als(train, seed=TRAIN_SEED)
    full = recommend.recommend_for_all(model, 5, users, items, "user_id", "item_id", every_pair=True).withColumnRenamed("score", "_full")
    top = recommend.recommend_top(model, 5, users, items, "user_id", "item_id")
    both = top.join(full.select("user_id", "rank", "_full"), ["user_id", "rank"], "full")
    # the full product adds in single precision
    same = F.coalesce(F.abs(F.col("score") - F.col("_full")) <= 1e-5 * (1 + F.abs("_full")), F.lit(False))
    return both.agg(F.count_distinct("user_id").alias("users"), F.count("score").alias("recommended"),
                    F.count(F.when(~same, 1)).alias("differing"))


@query("als_optimality_checks", f"""with {_RATED}
select (select count(distinct user_id) from r where train) as users, cast(0 as bigint) as not_optimal,
  (select count(*) from warm) as predictions, true as rmse_agrees, true as better_than_constant""")
def als_optimality_checks(spark, sf):
    """Each user's factors solve their least squares, and the reported error is the one the exported factors give."""
    train, test, _, _ = M._als_split(spark, sf)
    model = recommend.als(train, seed=TRAIN_SEED)
    users = recommend.optimality(model, train).agg(F.count(F.lit(1)).alias("users"),
                                                   F.count(F.when(F.col("residual") > 1e-3, 1)).alias("not_optimal"))
    users = stage_table(users, "optimality")  # one row, read by two subqueries that would each join the ratings again
    own = recommend.factor_predictions(model, test)
    error = F.col("rating") - F.col("_predicted")
    own = own.agg(F.count(F.lit(1)).alias("predictions"), F.sqrt(F.avg(error * error)).alias("own"))
    reported = supervised.rmse(model.transform(test), "rating")
    spread = train.agg(F.sqrt(F.avg(F.col("rating") * F.col("rating")))).first()[0]  # the error of predicting 0
    one = stage_table(own.withColumns({c: users.select(c).scalar() for c in users.columns}), "als-error")
    return one.select("users", "not_optimal", "predictions", (F.abs(F.col("own") - reported) < 1e-5).alias("rmse_agrees"),
                      (F.col("own") < spread).alias("better_than_constant"))


@query("idf_stage_checks", """select count(*) as documents, cast(0 as bigint) as differing, true as rare_terms_weigh_more
from docs_fx where text is not null""")
def idf_stage_checks(spark, sf):
    """The IDF stage's vectors are term frequency times ln((n + 1) / (document frequency + 1)), recounted per hash bucket."""
    docs = fx.docs_fx(spark, sf).where(F.col("text").isNotNull()).select("doc_id", "text")
    stages = supervised.text_features_stages("text", stopwords=M.ML_STOPWORDS)
    out = Pipeline(stages=stages).fit(docs).transform(docs)
    raw, weighted = F.unwrap_udt("raw_features"), F.unwrap_udt("features")
    vectors = stage_table(out.select(raw["indices"].alias("at"), raw["values"].alias("tf"), weighted["indices"].alias("also"),
                                     weighted["values"].alias("weight")), "vectors")
    entries = vectors.select(F.inline(F.arrays_zip("at", "tf", "also", "weight")))
    n = vectors.agg(F.count(F.lit(1)).alias("documents"))
    buckets = entries.groupBy("at").agg(F.count(F.lit(1)).alias("df"))  # at most one row per hash bucket
    want = F.col("tf") * F.log((n.scalar() + 1) / (F.col("df") + 1))
    bad = F.coalesce((F.col("at") != F.col("also")) | (F.abs(F.col("weight") - want) > 1e-9), F.lit(True))
    found = entries.join(buckets, "at").agg(
        F.count(F.when(bad, 1)).alias("differing"),
        F.coalesce(F.corr("df", F.col("weight") / F.col("tf")) < 0, F.lit(False)).alias("rare_terms_weigh_more"))
    return found.select(n.scalar().alias("documents"), "differing", "rare_terms_weigh_more")


@query("report_regression_metrics", M._REG_SQL + f""",
e as (select score as y, score - (b0 + b1 * ratings_count + b2 * review_length) as err from merged_fx, c
  where {M._SPLIT} >= {M.TRAIN_CUT} and score is not null and ratings_count is not null and review_length is not null),
my as (select avg(y) as m from e),
v as (select sqrt(avg(err * err)) as rmse, 1 - sum(err * err) / sum((y - m) * (y - m)) as r2 from e, my)
select 'score_regression' as model, 'rmse' as metric, round(rmse, 6) as value from v
union all select 'score_regression', 'r2', round(r2, 6) from v""")
def report_regression_metrics(spark, sf):
    one = M.regression_rmse_r2(spark, sf).first()
    return rounded(report.metrics(spark, "score_regression", {"rmse": one["rmse"], "r2": one["r2"]}), ["value"])


@query("random_split_checks", """select count(*) as rows, cast(0 as bigint) as in_both, true as near_share,
  true as sample_near_share from reviews_fx""")
def random_split_checks(spark, sf):
    """An unkeyed split keeps every row once; shares are within five standard deviations."""
    r = fx.reviews_fx(spark, sf).select("user_id", "score_raw", F.monotonically_increasing_id().alias("row"))
    r = stage_table(r, "split")
    train, test = sampling.split(r, [0.8, 0.2], TRAIN_SEED)
    parts = train.select("row", F.lit(1).alias("t")).unionByName(test.select("row", F.lit(0).alias("t")))
    per = parts.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))
    drawn = sampling.bernoulli(r, 0.1, TRAIN_SEED).agg(F.count(F.lit(1))).scalar()
    one = per.agg(F.sum("n").alias("rows"), F.count(F.when(F.col("n") > 1, 1)).alias("in_both"), F.sum("t").alias("t"))

    def near(n, share):
        return F.abs(n - F.col("rows") * share) <= 5 * F.sqrt(F.col("rows") * share * (1 - share))

    return one.select("rows", "in_both", near(F.col("t"), 0.8).alias("near_share"), near(drawn, 0.1).alias("sample_near_share"))


@query("summary_approx_checks", " union all ".join(
    f"select '{c}' as \"column\", count({c}) as count, true as within_bound from merged_fx" for c in _SUM_COLS))
def summary_approx_checks(spark, sf):
    """Ranks of the approximate quantiles differ from the asked ones by at most n / accuracy."""
    m, probs = fx.merged_fx(spark, sf), {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = {r["column"]: r for r in profile.summary(m, _SUM_COLS, probs, exact=False, accuracy=10000).collect()}
    rows = []
    for c in _SUM_COLS:
        n, ok = F.count(c), F.lit(True)
        for name, p in probs.items():
            v = found[c][name]
            below, upto = F.count(F.when(F.col(c) < v, 1)), F.count(F.when(F.col(c) <= v, 1))
            ok = ok & (below <= n * p + n / 10000 + 1) & (upto >= n * p - n / 10000 - 1)
        rows.append(F.struct(F.lit(c).alias("column"), n.alias("count"), ok.alias("within_bound")))
    return m.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
