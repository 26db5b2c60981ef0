"""Invariants for the queries without an exact oracle (model fitting, random sampling)."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quire.sources import fixtures, read_table
from tests.conftest import SF_CHECK, SF_SMALL

Q = entry.queries()


def test_segments_cover_all_users(spark):
    seg = Q["reader_segments"](spark, SF_CHECK)
    sizes = Q["reader_segment_sizes"](spark, SF_CHECK).toPandas()
    users = Q["user_features"](spark, SF_CHECK).count()
    assert seg.count() == users == sizes["num_users"].sum()
    assert seg.select("cluster").distinct().count() == 4


def test_segments_reproducible(spark):
    a = Q["reader_segments"](spark, SF_SMALL).orderBy("user_id").select("user_id", "cluster").collect()
    b = Q["reader_segments"](spark, SF_SMALL).orderBy("user_id").select("user_id", "cluster").collect()
    assert a == b


def test_elbow_falls(spark):
    w = Q["elbow_wcss"](spark, SF_CHECK).orderBy("k").toPandas()["wcss"].tolist()
    assert len(w) == 6 and all(b <= a * 1.05 for a, b in zip(w, w[1:])) and w[-1] < w[0]


def test_pca(spark):
    sc = Q["pca_scores"](spark, SF_SMALL).toPandas()
    assert list(sc.columns) == ["user_id", "PC1", "PC2"]
    assert abs(sc["PC1"].mean()) < 1e-6 and sc["PC1"].var() >= sc["PC2"].var()
    grid = Q["pca_cluster_grid"](spark, SF_SMALL).toPandas()
    assert grid["count"].sum() == len(sc)


def test_classifier_accuracy(spark):
    acc = Q["sentiment_model_accuracy"](spark, SF_CHECK).first()
    assert acc["n"] > 0 and 0.0 <= acc["accuracy"] <= 1.0
    rt = Q["ml_model_roundtrip"](spark, SF_CHECK)
    assert rt.count() == acc["n"]


def test_nlp_features(spark):
    nf = Q["nlp_features"](spark, SF_SMALL).toPandas()
    assert (nf["num_terms"] <= nf["num_tokens"]).all()


def test_als(spark):
    pred = Q["als_predictions"](spark, SF_CHECK)
    assert pred.where(F.col("prediction") < 0).count() == 0 and pred.count() > 0
    top = Q["als_top5"](spark, SF_CHECK).toPandas()
    per = top.groupby("user_id")["item_id"].nunique()
    assert (per == 5).all() and sorted(top["rank"].unique()) == [1, 2, 3, 4, 5]
    rmse = Q["als_rmse"](spark, SF_CHECK).first()
    assert rmse["n"] == pred.count() and rmse["rmse"] > 0


def test_random_sampling_sizes(spark):
    n = Q["sample_bernoulli"](spark, SF_CHECK).count()
    assert 0.08 < n / Q["split_sizes"](spark, SF_CHECK).agg(F.sum("rows")).first()[0] < 0.12
    sizes = {r["split"]: r["rows"] for r in Q["split_random_sizes"](spark, SF_CHECK).collect()}
    total = fixtures.reviews_fx(spark, SF_CHECK).count()
    assert sum(sizes.values()) == total and 0.75 < sizes["train"] / total < 0.85


def test_views_keep_every_source_row(spark):
    """The views' dirt is added: no row, value or text of the source tables is missing."""
    for view, table, column in (("reviews_fx", "lineitem", None), ("books_fx", "part", None), ("docs_fx", "documents", "text"),
                                ("gap_fx", "events", "value")):
        have, source = fixtures.FIXTURES[view](spark, SF_SMALL), read_table(spark, SF_SMALL, table)
        assert have.count() >= source.count()
        if column:
            assert source.select(column).exceptAll(have.select(column)).isEmpty()


def test_report_schema(spark):
    sch = Q["report_schema"](spark, SF_SMALL).toPandas()
    assert sch["column"].tolist()[:3] == ["review_id", "user_id", "item_id"]


def test_pca_cluster_table(spark):
    t = Q["pca_cluster_table"](spark, SF_SMALL).toPandas()
    users = Q["user_features"](spark, SF_SMALL).count()
    assert len(t) == users and set(t["cluster"]) <= {0, 1, 2, 3} and t["user_id"].is_unique
