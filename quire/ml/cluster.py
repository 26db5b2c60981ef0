"""Reader segmentation: k-means, nearest-centre assignment, profiles, elbow, PCA."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.ml.features import assemble, standardize
from quire.operators.layout import stage_table


def stable_layout(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``key`` and sort inside partitions, so seeded
    algorithms that sample rows see the same layout on every run."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def prepare(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Standardise ``cols`` (population std), assemble ``features``, stable layout."""
    z = standardize(df, cols, suffix="_z")
    return assemble(stable_layout(z, key), [c + "_z" for c in cols])


def segment(df: DataFrame, cols: list[str], key: str, k: int = 4, seed: int = 42, max_iter: int = 20):
    """k-means (k-means|| start) on standardised ``cols``; returns (model, rows with ``cluster``).

    The prepared rows are written once to the shared folder: fitting and the returned rows read
    that table, nothing stays cached. Runs when called."""
    data = stage_table(prepare(df, cols, key), "segments")
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(data)
    return model, model.transform(data).drop("features")


SEED_ROWS = 20_000  # rows drawn for the starting centres: a bound on the sample, not on the rows that are clustered


def _starts(points: np.ndarray, ks: list[int], seed: int, tries: int = 8, rounds: int = 20) -> dict[int, np.ndarray]:
    """Starting centres for each k: the best of some k-means++ draws on the sample, after a few steps on it."""
    rng, best = np.random.default_rng(seed), {}
    for k in ks:
        least = np.inf
        for _ in range(tries):
            centres = points[rng.integers(len(points))][None]
            while len(centres) < k:
                far = ((points[:, None] - centres[None]) ** 2).sum(-1).min(1)
                if not far.sum():
                    break
                centres = np.vstack([centres, points[rng.choice(len(points), p=far / far.sum())]])
            for _ in range(rounds):
                near = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
                centres = np.array([points[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centres)])
            cost = ((points[:, None] - centres[None]) ** 2).sum(-1).min(1).sum()
            if cost < least:
                least, best[k] = cost, centres
    return best


def elbow(df: DataFrame, cols: list[str], key: str, ks: list[int], seed: int = 42, max_iter: int = 20,
          tol: float = 1e-4) -> DataFrame:
    """(k, wcss) for each k: within-cluster sum of squares on standardised ``cols``.

    Lloyd's steps of all k run together: every row finds its nearest centre for each k, and one aggregate per iteration gives
    all new centres and costs (one row per k and centre). The standardised rows are written once; rows with a null or NaN
    feature are left out. Centres start from k-means++ on at most ``SEED_ROWS`` rows, chosen by a hash of ``key``. No rows: none."""
    spark = df.sparkSession
    z = [f"_z{i}" for i in range(len(cols))]
    scaled = standardize(df, cols, suffix="_z").select(key, *[F.col(c + "_z").alias(n) for c, n in zip(cols, z)]).na.drop(subset=z)
    data = stage_table(scaled, "elbow")
    drawn = data.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(SEED_ROWS).select(*z).toPandas().to_numpy(float)
    if not len(drawn):
        return spark.createDataFrame([], "k int, wcss double")
    centres, costs, moving = _starts(drawn, ks, seed), {}, set(ks)
    for _ in range(max_iter + 1):
        each = []
        for k in sorted(moving):
            far = F.array(*[sum(((F.col(n) - float(x)) * (F.col(n) - float(x)) for n, x in zip(z, c)), F.lit(0.0))
                            for c in centres[k]])
            each.append(F.struct(F.lit(k).alias("k"), far.alias("far")))
        rows = data.select(*z, F.inline(F.array(*each))).withColumn("least", F.array_min("far"))
        rows = rows.withColumn("at", F.array_position("far", F.col("least")))
        found = rows.groupBy("k", "at").agg(F.sum("least").alias("cost"), *[F.avg(n).alias(n) for n in z]).collect()
        for k in sorted(moving):
            mine = [r for r in found if r["k"] == k]
            costs[k] = sum(r["cost"] for r in mine)
            before, after = centres[k], centres[k].copy()
            for r in mine:
                after[int(r["at"]) - 1] = [r[n] for n in z]
            centres[k] = after
            if ((after - before) ** 2).sum(1).max() <= tol ** 2:
                moving.discard(k)
        if not moving:
            break
    return spark.createDataFrame([(k, float(costs[k])) for k in ks], "k int, wcss double")


def assign(df: DataFrame, cols: list[str], centers: list[list[float]], out: str = "cluster") -> DataFrame:
    """Nearest of the given centres by squared Euclidean distance, ties to the
    lowest id. The centres are a literal array inside the expression."""
    pts = [[F.lit(float(x)) for x in c] for c in centers]
    dists = F.array(*[sum(((F.col(col) - cx) * (F.col(col) - cx) for col, cx in zip(cols, c)), F.lit(0.0))
                      for c in pts])
    return df.withColumn(out, (F.array_position(dists, F.array_min(dists)) - 1).cast("int"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Users per cluster."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("num_users"))


def cluster_profile(df: DataFrame, cols: list[str], cluster: str = "cluster", digits: int = 2) -> DataFrame:
    """Mean of each feature and user count per cluster, rounded."""
    return df.groupBy(cluster).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols],
                                   F.count(F.lit(1)).alias("num_users"))


def pca(df: DataFrame, cols: list[str], k: int = 2):
    """PCA of the standardised columns over rows without null or NaN in them. Returns (explained
    variance ratios, those rows with PC1..PCk).

    Means, deviations and all covariances come from one aggregate, run when called; the eigenvectors of
    the small correlation matrix are found on the driver, and the components are linear column
    expressions, so no row is shuffled. Each component's sign is fixed so that its largest absolute
    loading is positive. A constant column divides by 1. No rows: ratios and components are 0."""
    x = [F.col(c).cast("double") for c in cols]
    whole = df
    for c in x:
        whole = whole.where(c.isNotNull() & ~F.isnan(c))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    one = whole.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
                    *[F.covar_pop(x[i], x[j]).alias(f"v{i}_{j}") for i, j in pairs]).first()
    mean = [one[f"m{i}"] or 0.0 for i in range(len(cols))]
    scale = [max(one[f"v{i}_{i}"] or 0.0, 0.0) ** 0.5 or 1.0 for i in range(len(cols))]
    matrix = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = (one[f"v{i}_{j}"] or 0.0) / (scale[i] * scale[j])
    values, vectors = np.linalg.eigh(matrix)  # rising
    values, vectors = np.maximum(values[::-1][:k], 0.0), vectors[:, ::-1][:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])])
    loadings = vectors * signs
    total = np.trace(matrix)
    scores = {f"PC{j + 1}": sum(((c - mean[i]) * float(loadings[i, j] / scale[i]) for i, c in enumerate(x)), F.lit(0.0))
              for j in range(loadings.shape[1])}
    return [float(v / total) if total else 0.0 for v in values], whole.withColumns(scores)


def variance_table(spark: SparkSession, ratios: list[float]) -> DataFrame:
    return spark.createDataFrame([(f"PC{i + 1}", float(r)) for i, r in enumerate(ratios)],
                                 "component string, explained_variance double")

