"""Split CSV with quoted line breaks, pruned top-k items, bracketed quantiles, cell moments, batched k-means, one-scan counts."""

import csv
import io
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from quire.ml import cluster, inner_product, recommend
from quire.operators import clean, distribution, profile, quantile, sampling, stats, text
from __spark_entry__ import queries
from quire.plans import models
from quire.sources import fixtures as fx, quoted, read_csv


# --- CSV -----------------------------------------------------------------------------------------

def _csv_rows(n, seed):
    rnd = random.Random(seed)
    parts = ["plain", 'a "quoted" word', "line\nbreak", "carriage\r\nreturn", "\n\n", "é ü", "", ",", '"', '"\n"', "x" * 50]
    return [(str(i), rnd.choice([None, "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6)))]), rnd.choice(parts)) for i in range(n)]


def _write(path, rows, end="\r\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["id", "long text", "t/x"])
    for r in rows:
        out.write(",".join("" if v is None else '"' + v.replace('"', '""') + '"' for v in r) + end)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def tiny_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield set_to
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [37, 200, 4000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv_over_splits(spark, tmp_path, tiny_splits, size, end):
    rows = _csv_rows(120, 1), _csv_rows(90, 2)
    for i, part in enumerate(rows):
        _write(tmp_path / f"part{i}.csv", part, end)
    want = sorted(str(tuple(v or None for v in r)) for part in rows for r in part)  # Spark's parser reads "" as null
    tiny_splits(size)
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > (6 if size < 4000 else 2)  # several tasks per file
    got = quoted.read_quoted_csv(spark, str(tmp_path))
    assert got.columns == ["id", "long text", "t/x"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    typed = read_csv(spark, str(tmp_path), schema="id int, `long text` string, `t/x` string", multi_line="split")
    assert sorted(r["id"] for r in typed.collect()) == sorted(int(r[0]) for p in rows for r in p)
    if end == "\n":  # with other line ends, Spark's reader changes the breaks inside fields
        whole = read_csv(spark, str(tmp_path), schema=typed.schema, multi_line=True)
        assert typed.exceptAll(whole).isEmpty() and whole.exceptAll(typed).isEmpty()


def test_quoted_csv_of_one_long_record_and_blank_lines(spark, tmp_path, tiny_splits):
    tiny_splits(64)
    text = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'id,t\n\n1,"{text}"\n\n  \n2,"x"\n')
    (tmp_path / "b.csv").write_text('id,t\n3,"open\nto the end\n')
    got = {r["id"]: r["t"] for r in read_csv(spark, str(tmp_path), schema="id int, t string", multi_line="split").collect()}
    assert got[1] == text and got[2] == "x" and got[3].startswith("open\nto the end") and len(got) == 3
    (tmp_path / "b.csv").write_text("id,t\n")
    assert read_csv(spark, str(tmp_path / "b.csv"), multi_line="split", infer=False).count() == 0
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), strict_quotes=False, multi_line="split")


# --- top-k items ---------------------------------------------------------------------------------

@pytest.mark.parametrize("block,part", [(7, 13), (64, 1000), (1000, 1000)])
@pytest.mark.parametrize("k", [1, 5, 300])
def test_top_items_equal_the_full_product(spark, block, part, k):
    rng = np.random.default_rng(3)
    items = np.vstack([rng.gamma(0.4, 1.0, (150, 4)), rng.normal(size=(30, 4)), np.zeros((2, 4))]).round(2).astype(np.float32)
    items = np.vstack([items, items[:20]])  # equal factors: ties
    users = np.vstack([rng.gamma(1.0, 1.0, (40, 4)), -rng.gamma(1.0, 1.0, (9, 4)), np.zeros((1, 4))]).round(2).astype(np.float32)
    table = lambda m: spark.createDataFrame([(i * 3 + 1, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")
    got = inner_product.top_items(table(users).repartition(3), table(items).repartition(3), k, block, part).collect()
    want = set()
    for u, f in enumerate(users):
        score = np.zeros(len(items))
        for r in range(4):
            score += float(f[r]) * items[:, r].astype(float)
        for rank, i in enumerate(sorted(range(len(items)), key=lambda i: (-score[i], i))[:k]):
            want.add((u * 3 + 1, i * 3 + 1, rank + 1, score[i]))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_items_prune(spark):
    rng = np.random.default_rng(5)
    items = rng.uniform(0.5, 1.0, (400, 3)) * (1.0 / np.arange(1, 401))[:, None]
    table = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")
    seen = []
    scores = inner_product._scores
    try:
        inner_product._scores = lambda u, i: seen.append(1) or scores(u, i)  # runs in the workers; the result must not change
        got = inner_product.top_items(table(rng.uniform(0.5, 1, (20, 3))), table(items), 5, block=40).collect()
    finally:
        inner_product._scores = scores
    assert max(r["item"] for r in got) < 40 and len(got) == 100
    empty = table(np.zeros((0, 3)))
    assert inner_product.top_items(empty, table(items), 5).count() == 0 == inner_product.top_items(table(items), empty, 5).count()


def test_optimality_tells_fitted_factors_from_others(spark):
    rnd = random.Random(4)
    rows = [(float(u), float(i), float(rnd.randint(1, 5))) for u in range(30) for i in rnd.sample(range(25), 8)]
    train = spark.createDataFrame(rows, "user_index double, item_index double, rating double")
    model = recommend.als(train, rank=4, max_iter=4, seed=1)
    assert recommend.optimality(model, train).agg(F.max("residual")).first()[0] < 1e-3
    shifted = train.withColumn("rating", F.col("rating") + F.col("user_index") % 3)
    assert recommend.optimality(model, shifted).agg(F.max("residual")).first()[0] > 1e-2


# --- quantiles, densities ------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["continuous", "few", "heavy"])
def test_bracketed_quantiles_of_a_long_column(spark, kind):
    rng = np.random.default_rng(8)
    v = {"continuous": rng.normal(size=60_000), "few": rng.integers(0, 5, 60_000).astype(float),
         "heavy": np.where(rng.random(60_000) < 0.4, 7.0, rng.pareto(1.0, 60_000) * 10)}[kind]
    pdf = pd.DataFrame({"g": np.where(rng.random(60_000) < 0.9, "hot", "small"), "v": v})
    pdf.loc[:4, "v"] = [float("inf"), float("-inf"), 0.0, -0.0, float("inf")]
    df = spark.createDataFrame(pdf).repartition(8)
    probs = [0.0, 0.01, 0.333, 0.5, 0.99, 1.0]
    for method, name in (("disc", "inverted_cdf"), ("linear", "linear")):
        inner = probs[1:-1] if method == "linear" else probs  # inf - inf at the ends
        got = {(r["g"], r["p"]): r["value"] for r in quantile.quantiles_long(df, "v", inner, method, ["g"]).collect()}
        for g, part in pdf.groupby("g"):
            for p in inner:
                assert math.isclose(got[g, p], np.quantile(part["v"], p, method=name), rel_tol=1e-12, abs_tol=1e-12), (method, g, p)
    whole = {r["p"]: r["value"] for r in quantile.quantiles_long(df, "v", [0.25, 0.5], "disc").collect()}
    assert whole == {p: np.quantile(pdf["v"], p, method="inverted_cdf") for p in (0.25, 0.5)}


def test_brackets_keep_few_values(spark):
    df = spark.range(200_000).select(F.rand(3).alias("_v"))
    kept = quantile._inside_brackets(df, [0.01, 0.5, 0.99], [])
    inside, lumps, rows = kept.agg(F.count(F.when(F.col("_lump") == 0, 1)), F.sum("_lump"), F.sum("_w")).first()
    assert inside < 200_000 * 0.01 and lumps == 4 and rows == 200_000


def test_cell_moments_give_the_density(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(size=4000), rng.normal(30, 0.01, 500), [500.0, -80.0], np.full(300, 2.0)])
    got = distribution.kde(spark.createDataFrame(pd.DataFrame({"v": v})), "v", 120).orderBy("point").toPandas()
    h = len(v) ** -0.2 * v.std(ddof=1)
    x = np.linspace(v.min(), v.max(), 120)
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.allclose(got["x"], x) and np.abs(got["density"] - want).max() < 1e-10 / h
    narrow = distribution.kde(spark.createDataFrame(pd.DataFrame({"v": v})), "v", 50, bw_factor=1e-4).orderBy("point").toPandas()
    h = 1e-4 * v.std(ddof=1)
    x = np.linspace(v.min(), v.max(), 50)
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert np.abs(narrow["density"] - want).max() < 1e-10 / h


# --- k-means, counts, profile --------------------------------------------------------------------

def test_elbow_is_as_good_as_separate_fits(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(5, 3)) * 6
    x = np.vstack([rng.normal(c, 1.0, (300, 3)) for c in centres])
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=range(len(x)))
    pdf.loc[len(x)] = [np.nan, 1.0, 1.0, -1]
    df = spark.createDataFrame(pdf)
    got = {r["k"]: r["wcss"] for r in cluster.elbow(df.where("not isnan(a)"), ["a", "b", "c"], "id", [2, 4, 5, 7], seed=1).collect()}
    data = cluster.prepare(df.where("not isnan(a)"), ["a", "b", "c"], "id").cache()
    for k, cost in got.items():
        assert cost <= 1.05 * KMeans(k=k, seed=1).fit(data).summary.trainingCost, k
    data.unpersist()
    assert cluster.elbow(df.limit(0), ["a"], "id", [2]).count() == 0
    same = spark.range(6).selectExpr("id", "1.0 as a")
    assert [r["wcss"] for r in cluster.elbow(same, ["a"], "id", [2, 3]).collect()] == [0.0, 0.0]


def test_counts_of_all_keys_share_a_scan(spark, tmp_path):
    spark.createDataFrame([("x", 1, 5.0), ("x", None, None), (None, 1, 2.0), (None, None, 1.0)], "a string, b int, s double") \
        .write.parquet(str(tmp_path / "t"))
    out = stats.count_by_each(spark.read.parquet(str(tmp_path / "t")), ["a", "b"], "s")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in out.collect()} == {("a", "x", 1), ("a", None, 2), ("b", "1", 2), ("b", None, 1)}
    assert stats.count_by_each(spark.read.parquet(str(tmp_path / "t")), ["a", "b"], "s", nulls="drop").count() == 2


def test_overview_of_dirty_columns(spark):
    rows = [("b", 1.0, None), ("a", float("nan"), None), (None, 3.0, None), ("b", None, None), ("7", 2.0, None)]
    df = spark.createDataFrame(rows, "t string, v double, n int")
    got = {(r["column"], r["item"], r["rank"]): (r["value"], r["number"]) for r in profile.overview(df, ["t", "v", "n"], 2).collect()}
    assert got["t", "rows", None] == (None, 5.0) and got["t", "missing", None] == (None, 1.0) and got["v", "missing", None] == (None, 2.0)
    assert got["t", "min", None] == ("7", None) and got["t", "max", None] == ("b", None) and got["t", "mean", None] == (None, 7.0)
    assert got["v", "min", None] == (None, 1.0) and got["v", "max", None] == (None, 3.0) and got["v", "stddev", None] == (None, 1.0)
    assert got["t", "top", 1] == ("b", 2.0) and got["t", "top", 2] == (None, 1.0) and got["n", "top", 1] == (None, 5.0)
    assert ("n", "min", None) not in got and ("t", "stddev", None) not in got
    empty = profile.overview(df.limit(0), ["t"], 2).collect()
    assert sorted((r["item"], r["number"]) for r in empty) == [("missing", 0.0), ("rows", 0.0)]


def test_row_hashes_follow_distinct(spark):
    rows = [(None, "a", 0.0), ("a", None, -0.0), ("a", None, 0.0), (None, None, float("nan")), (None, None, float("nan")), ("a", "", 1.0), ("", "a", 1.0)]
    df = spark.createDataFrame(rows, "x string, y string, v double")
    one = clean.dedupe_report(df).first()
    assert (one["rows_before"], one["rows_after"]) == (7, df.distinct().count())


# --- ratings ---------------------------------------------------------------------------------------

@pytest.fixture
def star(spark, tmp_path):
    """Small tables with repeated and null item keys, null customers and lines without an order."""
    rnd = random.Random(5)
    lines = [(o, n, rnd.choice([None, *range(30)]), float(n)) for o in range(80) for n in range(1, 4)]
    orders = [(o, rnd.choice([None, *range(12)])) for o in range(70)]
    parts = [(p, f"title {p}", "b", "t", p) for p in [*range(25), 3, 3, 7, None, None]]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").withColumn("o_orderdate", F.current_timestamp()) \
        .write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_ratings_read_the_joined_rows_from_one_copy(spark, star):
    merged, rated = fx.merged_fx(spark, star), fx.rated_fx(spark, star)
    cols = ["review_id", "user_id", "item_id", "score"]
    assert sorted(map(str, rated.collect())) == sorted(map(str, merged.select(*cols).collect()))
    assert rated.count() > fx.reviews_fx(spark, star).count()
    r = queries()["ratings_matrix"](spark, star)
    assert not [f for f in r.inputFiles() if "lineitem" in f or "orders" in f]
    want = merged.where("user_id is not null and item_id is not null and score is not null")
    assert r.count() == want.count()
    number = lambda c: {x[0]: i for i, x in enumerate(merged.where(f"{c} is not null").groupBy(c).count().orderBy(F.desc("count"), c).collect())}
    users, items = number("user_id"), number("item_id")
    assert sorted((x.user_index, x.item_index, x.rating, x.review_id) for x in r.collect()) == \
        sorted((users[x.user_id], items[x.item_id], x.score, x.review_id) for x in want.collect())


def test_als_rows_are_written_once(spark, star):
    train, test, _, _ = models._als_split(spark, star)
    assert all("quire-ratings" in f for part in (train, test) for f in part.inputFiles())
    assert dict(train.dtypes)["user_index"] == "double"
    assert train.count() + test.count() == queries()["ratings_matrix"](spark, star).count()


def _reads(df, table):
    return [f for f in df.inputFiles() if table in f]


@pytest.mark.parametrize("shared", [False, True])
def test_regression_rows_are_written_once(spark, star, shared):
    """Spark ML reads the train rows several times; each reading would join reviews and items again."""
    train, test = models._reg_split(spark, star, models._shared_reviews(spark, star) if shared else None)
    assert not _reads(train, "lineitem") + _reads(test, "lineitem") + _reads(train, "part.parquet")
    whole = fx.merged_fx(spark, star).where("review_id is not null and score is not null and ratings_count is not null and review_length is not null")
    cols = ["score", *models.REG_FEATURES]
    for got, want in zip((train, test), sampling.split(whole, [0.8, 0.2], models.TRAIN_SEED, key="review_id")):
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect())) != []


@pytest.mark.parametrize("shared", [False, True])
def test_als_rows_carry_their_side_not_their_id(spark, star, shared):
    parts = models._als_split(spark, star, models._shared_reviews(spark, star) if shared else None)[:2]
    with_id = models._als_split(spark, star, keep=["review_id"])[:2]
    cols = ["user_index", "item_index", "rating"]
    rows = sampling.split(queries()["ratings_matrix"](spark, star), [0.8, 0.2], models.TRAIN_SEED, key="review_id")
    for part, again, want in zip(parts, with_id, rows):
        assert part.columns == cols and "review_id" in again.columns
        assert sorted(map(str, part.collect())) == sorted(map(str, want.select(*cols).collect())) != []
        assert sorted(map(str, again.select("review_id", *cols).collect())) == sorted(map(str, want.select("review_id", *cols).collect()))


def test_reviews_without_an_id_are_on_no_side(spark, star, monkeypatch):
    odd = fx.reviews_fx(spark, star).withColumn("review_id", F.when(F.col("review_id") % 3 > 0, F.col("review_id")))
    monkeypatch.setattr(models.fx, "reviews_fx", lambda *_: odd)
    train, test, _, _ = models._als_split(spark, star)
    want = fx.rated_with(spark, star, odd, ["review_id"]).na.drop().count()
    assert train.count() + test.count() == want > 0


def test_optimality_groups_by_the_key_of_its_join(spark):
    """A sum per user, and its join with the users' factors, move no row again after the arrays have gone to the users."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(held, ("false", "-1")):
        spark.conf.set(k, v)
    try:
        train = spark.createDataFrame([(float(u), float(i), float((u * i) % 5 + 1)) for u in range(9) for i in range(8)],
                                      "user_index double, item_index double, rating double")
        model = recommend.als(train, rank=3, max_iter=2, seed=1)
        df = recommend.optimality(model, train)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5  # rows by item, items, rows by user, users twice
        assert dict(df.dtypes)["user_index"] == "double" and df.count() == 9
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("each", [(7, 11), (1000, 1000)])
def test_all_pairs_in_bounded_groups(spark, each):
    rng = np.random.default_rng(3)
    users, items = rng.uniform(0, 1, (40, 3)), rng.uniform(0, 1, (30, 3))
    items[5] = items[9]
    table = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>")
    got = {(r.user, r["rank"]): r.score for r in inner_product.all_pairs(table(users), table(items), 5, *each).collect()}
    want = np.sort(users @ items.T, axis=1)[:, ::-1][:, :5]
    assert len(got) == 200 and all(abs(got[i, j + 1] - want[i, j]) < 1e-5 for i in range(40) for j in range(5))
    assert inner_product.all_pairs(table(users).limit(0), table(items), 5).count() == 0


def test_all_pairs_sends_each_user_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    users, items = rng.uniform(0, 1, (300, 3)).astype(np.float32), rng.uniform(0, 1, (200, 3)).astype(np.float32)
    items[100:150] = items[:50]  # ties, also across blocks
    table = lambda m: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>")
    plans = []
    for name in ("stage_table", "cache"):
        def seen(df, *args, real=getattr(inner_product, name, None)):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return real(df, *args)
        monkeypatch.setattr(inner_product, name, seen, raising=False)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = inner_product.all_pairs(table(users), table(items), 5, 40, 30)  # 8 tasks, 7 blocks of items
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    # before, each user was copied for every group of items, each item for every group of users, and lists per group were shuffled
    assert not any(word in plan for plan in plans for word in ("CoGroup", "explode(sequence", "Window"))
    assert max(plan.count("Repartition") for plan in plans) <= 1
    got = {(r.user, r["rank"]): r.item for r in out.collect()}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    scores = np.matmul(users, items.T)
    want = {(u, n + 1): i for u in range(300) for n, i in enumerate(sorted(range(200), key=lambda i: (-scores[u, i], i))[:5])}
    assert got.keys() == want.keys() and all(abs(scores[u, got[u, n]] - scores[u, want[u, n]]) < 1e-6 for u, n in want)
    assert all(len({got[u, n] for n in range(1, 6)}) == 5 for u in range(300))
    few = inner_product.all_pairs(table(users), table(items[:3]), 5, 40, 2)  # fewer than k: all of them
    assert few.count() == 900 and few.where("rank > 3").count() == 0


def test_recommend_for_all_forms_no_cross_join(spark):
    train = spark.createDataFrame([(float(u), float(i), float((u * i) % 5 + 1)) for u in range(9) for i in range(8)],
                                  "user_index double, item_index double, rating double")
    model = recommend.als(train, rank=3, max_iter=2, seed=1)
    names = lambda c: train.select(c).distinct().withColumn(c[:4] + "_id", F.col(c).cast("long"))
    lists = []
    for every_pair in (False, True):
        df = recommend.recommend_for_all(model, 4, names("user_index"), names("item_index"), "user_id", "item_id", every_pair=every_pair)
        assert "CartesianProduct" not in df._jdf.queryExecution().toString() and "Join Cross" not in df._jdf.queryExecution().toString()
        assert dict(df.dtypes)["score"] == "float"
        lists.append({(r.user_id, r["rank"]): round(r.score, 4) for r in df.collect()})
    assert lists[0].keys() == lists[1].keys() and len(lists[0]) == 36
    assert all(abs(lists[0][x] - lists[1][x]) < 2e-4 for x in lists[0])


# --- grouped quantiles, words and pairs ------------------------------------------------------------

def test_brackets_do_not_move_the_rows(spark, monkeypatch):
    base = spark.range(4000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("_v"))
    plan = quantile._inside_brackets(base, [0.25, 0.5], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_words_and_pairs_in_one_pass(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["x", "y", None]), w) for w in [None, [], ["a"], ["the"]] + [[rnd.choice("abc") if rnd.random() < 0.8 else "the" for _ in range(9)] for _ in range(60)]]
    df = spark.createDataFrame(rows, "label string, words array<string>")
    for stop in (["the"], []):
        single, pairs = text._words_and_pairs(df, "", stop, ["label"], "words")
        assert len(single.inputFiles()) and all("quire-pairs" in f for f in single.inputFiles() + pairs.inputFiles())
        for got, want in ((single, text.keyword_counts(df, "", stop, ["label"], "words")), (pairs, text.pair_counts(df, "", stop, ["label"], "words"))):
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
