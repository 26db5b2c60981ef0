"""Global positions over a sort order without funnelling rows through one task.

Range-partition by the order, take running sums inside each partition, pin
the result (so partition ids stay fixed), then add per-partition offsets.
The offset table has at most (partitions x groups-per-partition) rows; without
groups it has at most ``partitions`` rows and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.layout import pin


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return int(partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def weighted_positions(df: DataFrame, order: list[Column], weight: str | None = None,
                       within: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``_before`` (sum of weights of rows strictly earlier in ``order``,
    restarted per ``within`` group) and ``_total`` (group total).

    ``order`` must start with the ``within`` columns. Without ``weight`` each
    row weighs 1, so ``_before`` is the 0-based row position.
    """
    within = list(within or [])
    p = _partitions(df, partitions)
    w_col = F.col(weight) if weight else F.lit(1).cast("bigint")
    staged = (df.withColumn("_wt", w_col)
                .repartitionByRange(p, *order)
                .withColumn("_pid", F.spark_partition_id()))
    if weight is None and not within:
        # Row positions: sort inside each range partition; the generated id is
        # (partition << 33) + position in partition, so no further shuffle.
        staged = staged.sortWithinPartitions(*order).withColumn(
            "_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    else:
        run = Window.partitionBy("_pid", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        staged = staged.withColumn("_local", F.coalesce(F.sum("_wt").over(run), F.lit(0)).cast("bigint"))
    staged = pin(staged)
    parts = staged.groupBy("_pid", *within).agg(F.sum("_wt").alias("_part"))
    grp = Window.partitionBy(*within)
    parts = parts.select(
        "_pid", *within,
        F.coalesce(F.sum("_part").over(grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).cast("bigint").alias("_off"),
        F.sum("_part").over(grp).cast("bigint").alias("_total"),
    )
    if not within:
        parts = F.broadcast(parts)  # at most `p` rows
    out = staged.join(parts, ["_pid", *within])
    return out.withColumn("_before", F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off", "_wt")


def dense_index(df: DataFrame, order: list[Column], name: str = "index", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (ties broken arbitrarily; make
    the order total to get a stable numbering)."""
    out = weighted_positions(df, order, partitions=partitions)
    return out.withColumnRenamed("_before", name).drop("_total")


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, key: list[str],
                    rank_col: str = "rank", buckets: int = 64) -> DataFrame:
    """Exact top-k rows per group; ``key`` names columns unique within a group
    that break ties (ascending).

    For k up to ``spark.sql.optimizer.windowGroupLimitThreshold`` one window
    suffices: Spark plans a partial per-partition limit before the shuffle, so
    each task sends at most k rows per group and a group holding a third of
    all rows costs nothing extra. Beyond that threshold the limit is done in
    two explicit rounds: top k inside (group, hash bucket of key), then top k
    of the at most ``buckets * k`` survivors.
    """
    full = list(order) + [F.col(c).asc() for c in key]
    final = Window.partitionBy(*group).orderBy(*full)
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    src = df
    if k > threshold:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(buckets))
        local = Window.partitionBy(*group, "_bucket").orderBy(*full)
        src = (df.withColumn("_bucket", spread)
                 .withColumn("_r1", F.row_number().over(local))
                 .where(F.col("_r1") <= k).drop("_r1", "_bucket"))
    return src.withColumn(rank_col, F.row_number().over(final)).where(F.col(rank_col) <= k)
