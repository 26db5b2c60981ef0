"""The workflow from two files to every table; CSV ingest."""

import os

import pandas as pd
import pytest

from quire.plans import workflow
from quire.sources import read_csv

LEXICON = [("good", 0.75), ("great", 0.875), ("bad", -0.75), ("boring", -1.0)]


def _files(folder):
    books = pd.DataFrame([{"Title": f"Book {i}" if i else None, "description": None, "authors": f"['Author {i % 4}']",
                           "image": "x", "previewLink": "x", "publisher": "A&C Black", "publishedDate": 1990 + i, "infoLink": "x",
                           "categories": f"['Cat {i % 3}']", "ratingsCount": "A&C Black" if i == 3 else i * 5} for i in range(12)])
    words = ["good great story", "bad boring story,\nwith a \"quoted\" word", "a plain story of été", "great good book"]
    reviews = pd.DataFrame([{"Id": i, "Title": f"Book {i * 7 % 13}", "Price": None, "User_id": f"U{i * i % 17}", "profileName": "p",
                             "review/helpfulness": "1/2", "review/score": "bad row" if i == 50 else 1 + (i * 3 + i % 4) % 5,
                             "review/time": 900000000 + i * 3000000, "review/summary": "s", "review/text": f"{words[i % 4]} {i}"}
                            for i in range(160)])
    paths = [str(folder / "books.csv"), str(folder / "reviews.csv")]
    books.to_csv(paths[0], index=False)
    reviews.to_csv(paths[1], index=False)
    return paths, books, reviews


def test_workflow_writes_every_table(spark, tmp_path):
    (books, reviews), _, rows = _files(tmp_path)
    lexicon = spark.createDataFrame(LEXICON, "word string, polarity double")
    out = workflow.run(spark, books, reviews, str(tmp_path / "out"), lexicon, min_count=5, clusters=3)
    read = {n: spark.read.parquet(p) for n, p in out.items() if not n.startswith("models/")}
    assert all(os.listdir(p) for p in out.values())
    assert {n for n, df in read.items() if df.isEmpty()} == set()
    assert read["raw_reviews"].count() == len(rows) == read["reviews"].count() == read["merged"].count()
    assert read["books"].count() == 11  # one has no title
    assert read["match_report"].first()["unmatched_rows"] == rows["Title"].isin(["Book 0", "Book 12"]).sum()
    assert read["merged"].where("`review/score` is null").count() == 1
    assert read["book_stats"].agg({"review_count": "sum"}).first()[0] == len(rows) - 1
    users = rows["User_id"].nunique()
    assert read["segments"].count() == users == read["segment_profile"].agg({"num_users": "sum"}).first()[0]
    assert {r["model"] for r in read["model_metrics"].collect()} == {"sentiment_classifier", "score_regression", "als"}
    top = read["recommendations"].toPandas().groupby("User_id")
    assert (top["Title"].nunique() == 5).all()
    assert {"models/sentiment", "models/score_regression", "models/als", "models/segments"} <= set(out)
    assert read["sentiment_distribution"].agg({"count": "sum"}).first()[0] == len(rows)


def test_nothing_stays_cached(spark):
    """Spark ML itself holds the factors of a recommender until its model is collected; nothing else stays."""
    import __spark_entry__ as entry
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("reader_segments", "pca_cluster_grid", "trend_top_categories", "idf_weights", "sentiment_label"):
        entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_large_files_are_split(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    with open(path, "w") as f:
        f.write("id,text\n")
        f.writelines(f'{i},"some ""quoted"", text {i}"\n' for i in range(60000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200000)
    try:
        one = read_csv(spark, path, schema="id int, text string")
        assert one.rdd.getNumPartitions() > 5
        assert read_csv(spark, path, schema="id int, text string", multi_line=True).rdd.getNumPartitions() == 1
        assert one.where("text = concat('some \"quoted\", text ', id)").count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_breaks_in_fields_need_the_option(spark, tmp_path):
    (_, reviews), _, rows = _files(tmp_path)
    with pytest.raises(ValueError, match="multi_line"):
        read_csv(spark, reviews)
    got = read_csv(spark, reviews, multi_line=True, infer=False)
    assert {r[0] for r in got.select("`review/text`").collect()} == set(rows["review/text"])
