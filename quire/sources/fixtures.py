"""Fixture views: the review/book domain expressed over the driver tables.

The driver tables are a star schema (orders, lineitem, part, ...). These
functions map them onto the shapes the analytics expect - a review table, an
item table, their merge, labelled texts, a table with full-row copies and a
time series with gaps, NaN and nulls. Every row and text of the source tables is
kept; unmatched items, missing texts, copies, gaps and missing values are added as
further rows. The same definitions exist as SQL text in
:mod:`quire.plans.fixture_sql` for the DuckDB oracle; both must agree.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.layout import stage_table
from quire.session import session_key
from quire.sources.files import read_table


def _null() -> Column:
    return F.lit(None)


def _also(condition: Column, extra: int = 1) -> Column:
    """Generates 0 for every row, and 1..``extra`` besides where ``condition`` holds."""
    return F.explode(F.when(condition, F.sequence(F.lit(0), F.lit(extra))).otherwise(F.array(F.lit(0))))


def _view(fn):
    """Build each view once per session and folder (a plan, not data)."""
    built: dict[tuple, DataFrame] = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (session_key(spark), sf_dir.rstrip("/"))
        if key not in built:
            built[key] = fn(spark, sf_dir)
        return built[key]

    def use(spark: SparkSession, sf_dir: str, df: DataFrame) -> None:
        built[(session_key(spark), sf_dir.rstrip("/"))] = df

    wrapper.use = use
    return wrapper


@_view
def reviews_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item: user = customer of the order, item = part. Every
    tenth line adds a review of an item that the item table does not have."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    j = j.withColumn("added", _also((F.col("l_orderkey") + F.col("l_linenumber")) % 10 == 9))
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    score_raw = (F.when((ok + ln) % 41 == 0, _null().cast("string"))
                 .when((ok + pk) % 97 == 0, F.lit("Random House"))
                 .otherwise((F.lit(1) + (ok * 7 + pk * 3 + ln) % 5).cast("double").cast("string")))
    return j.select(
        ((ok * 10 + ln) * 2 + F.col("added")).cast("bigint").alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("added") == 0, pk).otherwise(-pk).alias("item_id"),
        score_raw.alias("score_raw"),
        (F.lit(788918400) + ((ok * 37 + ln) % 2400) * 86400).cast("bigint").alias("review_time"),
        F.col("o_orderdate").alias("review_ts"),
        F.col("l_quantity").cast("int").alias("review_length"),
    )


@_view
def books_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item table: list-valued text, nulls, bad counts, outliers."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    pk = F.col("p_partkey")
    ratings = (F.when(pk % 3 == 0, _null().cast("string"))
               .when(pk % 101 == 0, F.lit("A&C Black"))
               .when(pk % 50 == 1, (F.col("p_size") * 40).cast("string"))
               .otherwise(F.col("p_size").cast("string")))
    return p.select(
        pk.alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit("']")).alias("authors"),
        F.when(pk % 6 == 0, _null().cast("string"))
         .otherwise(F.concat(F.lit("['"), F.col("p_type"), F.lit("']"))).alias("categories"),
        ratings.alias("ratings_raw"),
    )


@_view
def merged_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join of reviews to items plus the safe casts of score and ratings count."""
    return merged_with(spark, sf_dir, reviews_fx(spark, sf_dir)).select(
        "review_id", "user_id", "item_id", "score_raw", "review_time", "review_ts", "review_length",
        "title", "authors", "categories", "score", "ratings_count")


def merged_with(spark: SparkSession, sf_dir: str, reviews: DataFrame) -> DataFrame:
    """The merge for ``reviews`` that hold item_id, score_raw and any other columns."""
    b = books_fx(spark, sf_dir).select("item_id", "title", "authors", "categories", "ratings_raw")
    m = reviews.join(b, "item_id", "left")
    return m.withColumns({"score": F.col("score_raw").try_cast("double"),
                          "ratings_count": F.col("ratings_raw").try_cast("int").cast("double")}).drop("ratings_raw")


@_view
def rated_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of merged_fx as (review_id, user_id, item_id, score)."""
    return rated_with(spark, sf_dir, reviews_fx(spark, sf_dir), ["review_id"])


def rated_with(spark: SparkSession, sf_dir: str, reviews: DataFrame, keep: list[str]) -> DataFrame:
    """The rows of the merge as (keep..., user_id, item_id, score). A left join changes these only by items that the item
    table lists more than once; those ids are counted and written first, so that a few of them reach the reviews without a shuffle."""
    times = read_table(spark, sf_dir, "part", ["p_partkey"]).groupBy(F.col("p_partkey").alias("item_id")).agg(F.count(F.lit(1)).alias("times"))
    again = stage_table(times.where("item_id is not null and times > 1"), "repeated-items")
    r = reviews.select(*keep, "user_id", "item_id", F.col("score_raw").try_cast("double").alias("score"))
    m = r.join(again, "item_id", "left")
    copies = F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1))))
    return m.select(*keep, "user_id", "item_id", "score", copies.alias("_copy")).drop("_copy")


@_view
def docs_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts with a score where a label exists; every 43rd document adds a row
    without text, under a negative id."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "text"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    j = d.join(lab, "doc_id", "left").withColumn("added", _also(F.col("doc_id") % 43 == 0))
    did, kept = F.col("doc_id"), F.col("added") == 0
    return j.select(
        F.when(kept, did).otherwise(-1 - did).alias("doc_id"), "lang", "source",
        F.when(kept, F.col("text")).alias("text"),
        F.when(F.col("quality") == 1, (F.lit(4) + did % 2).cast("double"))
         .when(F.col("quality") == 0, (F.lit(1) + did % 3).cast("double")).alias("score"),
    )


@_view
def dup_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow projection of reviews; every third review comes with three further copies."""
    r = reviews_fx(spark, sf_dir).withColumn("added", _also(F.col("review_id") % 3 == 0, 3))
    return r.select("user_id", "item_id", "score_raw")


@_view
def gap_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; some are repeated with NaN or null values, and some 400 days later, on
    days that have few other events."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    eid = F.col("event_id")

    def row(days: int, value: Column) -> Column:
        return F.struct(F.lit(days).alias("days"), value.cast("double").alias("value"))

    def only(condition: Column, extra: Column) -> Column:
        return F.when(condition, F.array(extra)).otherwise(F.array().cast("array<struct<days:int,value:double>>"))

    rows = F.concat(F.array(row(0, F.col("value"))),
                    only(eid % 53 == 0, row(0, F.lit(float("nan")))),
                    only(eid % 31 == 0, row(0, _null())),
                    only(eid % 97 == 0, row(400, F.col("value"))))
    e = e.select(eid, "ts", "user_id", "event_type", F.inline(rows))
    return e.select("event_id", (F.col("ts") + F.make_dt_interval(F.col("days"))).alias("ts"), "user_id",
                    "event_type", "value")


FIXTURES = {
    "reviews_fx": reviews_fx,
    "books_fx": books_fx,
    "merged_fx": merged_fx,
    "docs_fx": docs_fx,
    "dup_fx": dup_fx,
    "gap_fx": gap_fx,
}


def stage_views(spark: SparkSession, sf_dir: str, out_dir: str,
                names: tuple[str, ...] = ("reviews_fx", "books_fx", "merged_fx", "docs_fx")) -> dict[str, str]:
    """Write the views once as parquet under ``out_dir`` (shared storage) and
    make every later query of this session read the written tables.

    The merge joins the two largest tables; running many analyses on a staged
    copy computes that join once instead of once per query (the original
    workflow also writes its merged table before analysing it).
    """
    paths = {}
    for name in names:
        path = f"{out_dir.rstrip('/')}/{name}"
        FIXTURES[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        paths[name] = path
    for name, path in paths.items():
        FIXTURES[name].use(spark, sf_dir, spark.read.parquet(path))
    return paths
