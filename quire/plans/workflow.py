"""The whole analysis: two CSV paths and an output folder in, tables and models out.

``run(spark, books_csv, reviews_csv, out)`` ingests both files, cleans and merges them, and writes every
analysis, chart and model table as parquet under ``out``, the fitted models under ``out/models`` and the
recommendations as a table. Each step reads what an earlier step wrote, so nothing is computed twice, nothing
stays cached, and a lost executor costs a re-read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scalar import strip_list
from quire.ml import cluster, recommend, supervised
from quire.operators import clean, distribution, enrich, profile, report, reshape, sampling, stats, text, timeseries, topk
from quire.sources import csv_to_parquet, save_model, write_parquet

USER_FEATURES = ["avg_review_score", "num_reviews", "avg_review_length"]
REGRESSION = ["ratingsCount", "review_length"]
SCORE, USER, TITLE, TEXT = "review/score", "User_id", "Title", "review/text"


def run(spark: SparkSession, books_csv: str, reviews_csv: str, out: str, lexicon: DataFrame | None = None,
        stopwords: list[str] | None = None, zone: str = "UTC", multi_line: bool | str = "split", min_count: int = 50, clusters: int = 4,
        seed: int = 42) -> dict[str, str]:
    """Write all tables; returns {name: path}. ``lexicon`` (word, polarity) is needed for the sentiment tables,
    which are left out without it. ``multi_line`` allows line breaks inside quoted fields of the files. Model steps
    need some scored reviews with text of both labels."""
    out, paths = out.rstrip("/"), {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_parquet(df, f"{out}/{name}")
        return spark.read.parquet(paths[name])

    def keep(name: str, model) -> None:
        paths[f"models/{name}"] = save_model(model, f"{out}/models/{name}")

    def raw(name: str, src: str) -> DataFrame:
        paths[name] = csv_to_parquet(spark, src, f"{out}/{name}", multi_line=multi_line, infer=False)
        return spark.read.parquet(paths[name])

    raw_books, raw_reviews = raw("raw_books", books_csv), raw("raw_reviews", reviews_csv)
    for name, df in (("books", raw_books), ("reviews", raw_reviews)):
        put(f"{name}_missing", profile.missing(df))
        put(f"{name}_schema", report.schema_table(spark, df, with_nulls=True))
    put("books_summary", profile.describe(raw_books, raw_books.columns))
    put("books_outliers", clean.quantile_bounds(clean.safe_cast(raw_books, {"ratingsCount": "double"}), "ratingsCount"))
    books = put("books", clean.clean_items(raw_books))
    reviews = put("reviews", clean.clean_reviews(raw_reviews, zone=zone))
    put("match_report", enrich.match_report(reviews, books, TITLE))
    merged = enrich.merged_features(reviews, books, TITLE, score=SCORE, count="ratingsCount", time_col="review/time", text=TEXT,
                                    drop=["image", "previewLink", "infoLink"], zone=zone)
    merged = put("merged", merged.withColumns({c: strip_list(c) for c in ("categories", "authors")}))

    _analysis(put, merged, min_count)
    if lexicon is not None:
        _sentiment(put, merged, lexicon, text.default_stopwords() if stopwords is None else stopwords)
    _segments(put, keep, merged, clusters, seed)
    _models(spark, put, keep, merged, seed)
    return paths


def _analysis(put, merged: DataFrame, min_count: int) -> None:
    items = put("book_stats", stats.item_stats(merged, TITLE, SCORE))
    put("most_reviewed", stats.most_reviewed(items, TITLE))
    put("top_rated", stats.top_rated(items, TITLE, min_count))
    put("popularity_vs_score", stats.corr_pair(merged, "ratingsCount", SCORE))
    put("popularity_grid", distribution.grid_density(merged, "ratingsCount", SCORE))
    put("corr_matrix", stats.corr_matrix(merged, [SCORE, "ratingsCount", "review_length"]))
    for name, column in (("category", "categories"), ("author", "authors")):
        counted = stats.count_by(merged, column, SCORE, nulls="drop")
        put(f"top_{name}", counted.orderBy(F.col("review_count").desc(), F.col(column).asc()).limit(10))
    trend = put("category_year", stats.count_by(merged, ["categories", "review_year"], SCORE, nulls="drop"))
    top = topk.frequent(merged.where(F.col(SCORE).isNotNull()), "categories", 10, nulls="drop")  # ten rows
    put("trend_top_categories", trend.join(F.broadcast(top.select("categories")), "categories", "left_semi"))
    put("category_share", stats.share_of_top(merged, "categories", 10))
    put("yearly_score", stats.yearly_mean(merged, value=SCORE))
    put("yearly_count", stats.yearly_count(merged, value=SCORE))
    years = [r[0] for r in merged.select("review_year").where("review_year is not null").distinct().orderBy("review_year").collect()]
    put("category_year_pivot", reshape.pivot_years(merged, "categories", "review_year", years, SCORE))  # a column per year
    timed = merged.withColumn("_ts", F.col("review/time_text").try_cast("timestamp_ntz"))
    put("monthly_volume", timeseries.resample(timed, "_ts", "month", value=SCORE))
    put("hist_score", distribution.histogram(merged, SCORE, 5))
    put("hist_length", distribution.histogram(merged, "review_length", 30))
    put("kde_length", distribution.kde(merged, "review_length"))
    put("length_by_score", distribution.box_stats(merged, SCORE, "review_length"))


def _sentiment(put, merged: DataFrame, lexicon: DataFrame, stopwords: list[str]) -> None:
    labelled = text.classify(merged.where(F.col(TEXT).isNotNull()).select(TITLE, USER, TEXT), TEXT, lexicon,
                             keep_text=False, tokens_out="words")
    labelled = put("sentiment", labelled)
    put("sentiment_distribution", text.distribution(labelled))
    strong = labelled.where(F.col("sentiment").isin("Positive", "Negative"))
    put("top_keywords", text.top_keywords(strong, TEXT, stopwords, 20, by=["sentiment"], tokens_col="words"))
    put("term_weights", text.term_weights(strong, TEXT, stopwords, 200, by=["sentiment"], tokens_col="words", bigrams=True))


def _segments(put, keep, merged: DataFrame, clusters: int, seed: int) -> None:
    users = stats.user_features(merged.where(F.col(USER).isNotNull()), USER, SCORE)
    users = put("user_features", clean.complete_cases(users, [USER, *USER_FEATURES]))
    capped = clean.cap_upper(clean.clip(users, "avg_review_score", 0.0, 5.0), ["num_reviews", "avg_review_length"], 0.99)
    capped = put("user_features_capped", capped)
    for c in USER_FEATURES:
        put(f"hist_{c}", distribution.histogram(capped, c, 30))
        put(f"kde_{c}", distribution.kde(capped, c))
    model, seg = cluster.segment(users, USER_FEATURES, USER, k=clusters, seed=seed)
    keep("segments", model)
    ratios, points = cluster.pca(seg, USER_FEATURES)
    points = put("segments", points.select(USER, *USER_FEATURES, "cluster", "PC1", "PC2"))
    put("segment_profile", cluster.cluster_profile(points, USER_FEATURES))
    put("segment_grid", distribution.grid_density(points, "PC1", "PC2", by=["cluster"]))
    put("pca_variance", cluster.variance_table(points.sparkSession, ratios))
    put("elbow", cluster.elbow(users, USER_FEATURES, USER, list(range(2, 8)), seed))


def _models(spark: SparkSession, put, keep, merged: DataFrame, seed: int) -> None:
    found = []
    docs = merged.where(F.col(TEXT).isNotNull() & F.col(SCORE).isNotNull()).select(
        F.col(TEXT).alias("text"), clean.score_label(SCORE).alias("sentiment_label"))
    train, test = sampling.split(docs, [0.8, 0.2], seed, key="text")  # equal texts stay on one side
    model = supervised.sentiment_classifier(put("train_texts", train), "text", "sentiment_label")
    keep("sentiment", model)
    found.append(report.metrics(spark, "sentiment_classifier",
                                {"accuracy": supervised.accuracy(model.transform(test))}))
    whole = merged.select(USER, TITLE, "review/time", SCORE, *REGRESSION).na.drop(subset=[SCORE, *REGRESSION])
    whole = whole.withColumn("_key", F.concat_ws("|", USER, TITLE, "review/time"))
    train, test = sampling.split(whole, [0.8, 0.2], seed, key="_key")
    linear = supervised.score_regression(train, REGRESSION, SCORE)
    keep("score_regression", linear)
    one = supervised.regression_metrics(linear, test, REGRESSION, SCORE).first()
    found.append(report.metrics(spark, "score_regression", {m: one[m] for m in ("rmse", "r2") if one[m] is not None}))
    keyed = merged.withColumn("_key", F.concat_ws("|", USER, TITLE, "review/time"))
    rated, users, items = recommend.ratings(keyed, USER, TITLE, SCORE, keep=["_key"])
    train, test = sampling.split(put("ratings", rated), [0.8, 0.2], seed, key="_key")
    factors = recommend.als(train, seed=seed)
    keep("als", factors)
    error = supervised.rmse(factors.transform(test), "rating")
    found.append(report.metrics(spark, "als", {"rmse": error}))
    put("recommendations", recommend.recommend_top(factors, 5, users, items, USER, TITLE))
    put("model_metrics", report.combine(*found))
