"""One key holding a third of all rows: results stay exact (brute force in pandas)."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quire.ml.features import index_labels
from quire.operators import enrich, quantile, ranking, stats


def _skewed(n=3000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        item = 0 if i % 3 == 0 else rnd.randint(1, 200)
        rows.append((i, item, rnd.randint(1, 400), float(rnd.randint(1, 5)) if rnd.random() > 0.05 else None))
    return rows


def test_skewed_grouping_and_quantiles(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "rid long, item long, user long, score double").repartition(6)
    pdf = pd.DataFrame(rows, columns=["rid", "item", "user", "score"])
    got = {r["item_id"]: (r["review_count"], r["avg_review_score"])
           for r in stats.item_stats(df.withColumnRenamed("item", "item_id")).collect()}
    want = pdf.groupby("item")["score"].agg(["count", "mean"])
    assert got[0][0] == want.loc[0, "count"] and abs(got[0][1] - want.loc[0, "mean"]) < 1e-12
    q = quantile.quantiles_long(df, "score", [0.1, 0.5, 0.9], "linear", by=["item"], partitions=5).toPandas()
    hot = pdf[pdf.item == 0]["score"].dropna().to_numpy()
    for p in (0.1, 0.5, 0.9):
        assert abs(q[(q.item == 0) & (q.p == p)]["value"].iloc[0] - np.quantile(hot, p)) < 1e-12


def test_skewed_topk_index_and_join(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "rid long, item long, user long, score double")
    top = ranking.top_k_per_group(df, ["item"], [F.col("user").desc()], 3, key=["rid"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["rid", "item", "user", "score"])
    exp = pdf[pdf.item == 0].sort_values(["user", "rid"], ascending=[False, True])["rid"].head(3).tolist()
    assert top[top.item == 0].sort_values("rank")["rid"].tolist() == exp
    idx = {r["item"]: r["item_index"] for r in index_labels(df, "item").collect()}
    assert idx[0] == 0.0 and sorted(idx.values()) == [float(i) for i in range(len(idx))]
    items = spark.createDataFrame([(0, "hot"), (0, "hot copy"), (1, "one")], "item long, name string")
    rep = enrich.match_report(df, items, "item").first()
    n_hot, n_one = (pdf.item == 0).sum(), (pdf.item == 1).sum()
    assert rep["output_rows"] == len(pdf) + n_hot and rep["matched_rows"] == n_hot + n_one
