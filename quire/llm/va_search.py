"""Exact top-k inner-product search with a vector-approximation file.

Every distinct vector is stored twice: as one byte per component naming its quantisation cell (the approximation file), and
exactly. A block of queries scans the cells; the cell edges bound every score from both sides, and a candidate
stays while its upper bound reaches the k-th best lower bound. The exact vectors are then read in the order of
those bounds, until the k-th result is certain."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import staged
from quire.session import scratch_path

SCALE = 1024
BITS = 6
BLOCK = 1024  # queries scanned together
FIRST_READ = 4  # exact vectors read at first, as a multiple of k + 1
LIMIT = 1 << 57  # of a scaled component, so that a sum of thousands of products fits decimal(38)
LONG = (1 << 63) - 1


def quantise(vector: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x), or null for a vector that is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(
        F.lit(float(scale)) * x.cast("double")))).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), whole)


def _bounds(low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """Cell edges per component: cell c holds the whole numbers from edges[d, c] to edges[d, c + 1] - 1."""
    steps = np.arange((1 << bits) + 1) / (1 << bits)
    return np.ceil(low[:, None] + (high - low + 1)[:, None] * steps[None, :])


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): for every id where ``is_query`` holds, its ``k`` highest integer inner products
    among all other ids, ties to the smaller id; all others, if fewer.

    Vectors that are null, or hold a null or non-finite component, and rows with a null id take no part. Every
    row is a candidate, so an id that is repeated can be found as often as it is there, also by its own other rows; rows that
    ask and are equal in id and vector share one list, those of one id with different vectors have one each. Missing components of
    shorter vectors are 0. Scaled components are held to +-2**57; scores are compared exactly and, where beyond a long, returned
    as its nearest value. Empty table: no rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), quantise(F.col(vector), scale).alias("v"),
                          is_query.alias("asks")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = staged(rows.groupBy("id", "v").agg(F.count("*").alias("n"), F.max("asks").alias("asks")), "va-rows")
    queries = staged(rows.where("asks").select(F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"),
                                               F.col("v").alias("q")), "va-queries")
    # equal vectors are one candidate with its k + 1 smallest ids: more can never be asked for
    least = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("nth") <= k + 1)
    exact = staged(least.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))
                   .select(F.monotonically_increasing_id().alias("cid"), "ids", "v"), "va-exact")
    spread = exact.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    spread = sorted(spread.collect())  # one row per component
    dims = len(spread)
    low = np.minimum(0, np.array([r["a"] for r in spread], float))
    high = np.maximum(0, np.array([r["b"] for r in spread], float))
    edges = _bounds(low, high, bits)
    fits = sum(max(-r["a"], r["b"]) ** 2 for r in spread) <= LONG  # no sum of products can pass a long
    kind = "long" if fits else "decimal(38,0)"
    if bits > 8:
        raise ValueError("a cell number must fit a byte")

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, dims), np.uint8)
            for i, v in enumerate(_matrix(batch.column("v"), dims).T):
                # edges beyond 2**53 are rounded; what that moves is far below the slack of the bounds
                codes[:, i] = np.clip(np.searchsorted(edges[i], v, side="right") - 1, 0, edges.shape[1] - 2)
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array([c.tobytes() for c in codes], pa.binary())],
                                             names=["cid", "cells"])

    cells = staged(exact.select("cid", "v").mapInArrow(approximate, "cid long, cells binary"), "va-cells")
    path = scratch_path(spark, "va-candidates")
    last, found = -(1 << 63), False
    while dims:  # one pass over the approximation file per block of queries, so the driver holds one block
        part = queries.where(F.col("query") > last).orderBy("query").limit(block).collect()
        if not part:
            break
        asked = np.zeros((len(part), dims))
        for i, r in enumerate(part):
            asked[i, :len(r["q"])] = r["q"]
        ids = np.array([r["query"] for r in part])
        cells.mapInArrow(_scan(ids, asked, edges, k), "query long, cid long, ub double, lb double") \
            .write.mode("append").parquet(path)
        last, found = int(ids[-1]), True
    schema = "query long, cid long, ub double, lb double"
    candidates = spark.read.schema(schema).parquet(path) if found else spark.createDataFrame([], schema)
    by_low = Window.partitionBy("query").orderBy(F.col("lb").desc())
    floor = candidates.withColumn("nth", F.row_number().over(by_low)).where(F.col("nth") == k + 1) \
        .select("query", F.col("lb").alias("floor"))
    live = candidates.join(floor, "query", "left").where("floor IS NULL OR ub >= floor")
    order = Window.partitionBy("query").orderBy(F.col("ub").desc(), "cid")
    live = staged(live.select("query", "cid", "ub", F.row_number().over(order).alias("nth")), "va-order")

    def scored(part: DataFrame) -> DataFrame:
        zero = F.lit(0).cast(kind)
        product = F.aggregate(F.zip_with("v", "q", lambda a, b: F.coalesce((a.cast(kind) * b.cast(kind)).cast(kind), zero)), zero,
                              lambda acc, x: (acc + x).cast(kind))
        own = (F.col("found.id") == F.col("query_id")) & (F.col("v") == F.col("q"))
        times = F.least(F.col("found.n") - own.cast("long"), F.lit(k).cast("long"))
        return part.join(exact, "cid").join(queries, "query") \
            .select("query", "query_id", "q", "v", product.alias("score"), F.explode("ids").alias("found")) \
            .select("query", "query_id", "score", F.col("found.id").alias("id"), times.alias("times")).where("times > 0") \
            .select("query", "query_id", "score", "id", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))) \
            .drop("col")

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    first = FIRST_READ * (k + 1)
    early = staged(scored(live.where(F.col("nth") <= first)).withColumn("rank", F.row_number().over(best))
                   .where(F.col("rank") <= k), "va-early")
    # certain once the next bound is below the k-th score; only what still could reach it is read
    certain = early.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
    rest = live.where(F.col("nth") > first).join(certain, "query", "left").where("kth IS NULL OR ub >= kth")
    score = F.greatest(F.lit(-LONG).cast(kind), F.least(F.lit(LONG).cast(kind), F.col("score"))).cast("long")
    return early.drop("rank").unionByName(scored(rest.select("query", "cid"))) \
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "id", score.alias("score"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return values.reshape(-1, dims).astype(float)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _scan(ids: np.ndarray, asked: np.ndarray, edges: np.ndarray, k: int):
    """Bounds of every query's scores over the cells of a partition; keeps what can still be among the best k.

    The floor is the (k + 1)-th best lower bound, as one candidate may be the query's own vector."""
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    dims = edges.shape[0]
    # room for rounding in the products, far below one unit for ordinary embeddings
    slack = 1e-12 * np.abs(asked) @ np.abs(edges).max(axis=1) + 0.5

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(ids), k + 1), -np.inf)
        kept = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                codes = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, dims)
                lows = np.take_along_axis(edges.T, codes, axis=0)
                highs = np.take_along_axis(edges.T, codes.astype(np.int64) + 1, axis=0) - 1
                ub = up @ highs.T + down @ lows.T + slack[:, None]
                lb = up @ lows.T + down @ highs.T - slack[:, None]
                best = np.partition(np.concatenate([best, lb], axis=1), -(k + 1), axis=1)[:, -(k + 1):]
                q, c = np.nonzero(ub >= best.min(axis=1)[:, None])
                kept.append((q, part.column("cid").to_numpy()[c], ub[q, c], lb[q, c]))
                if len(kept) >= 8:
                    kept = [_prune(kept, best)]
        if kept:
            q, cid, ub, lb = _prune(kept, best)
            for at in range(0, len(q), 100_000):
                s = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[s]]), pa.array(cid[s]), pa.array(ub[s]), pa.array(lb[s])],
                                                 names=["query", "cid", "ub", "lb"])
    return scan


def _prune(kept: list, best: np.ndarray) -> tuple:
    q, cid, ub, lb = (np.concatenate(x) for x in zip(*kept))
    on = ub >= best.min(axis=1)[q]
    return q[on], cid[on], ub[on], lb[on]
