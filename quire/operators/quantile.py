"""Exact quantiles, distributed, without moving the column.

A mergeable quantile summary (one row per group) brackets every target rank between two
values. One more pass counts the rows below each bracket and keeps the values inside, collapsed to
(value, multiplicity) with a map-side combine: the rows outside become one lump per gap. What is
shuffled is thus the values inside the brackets, a few thousandths of a large column. Those rows are
range-partitioned, partition totals locate the target ranks, and only the partitions that hold one are
ranked row by row. No task ever holds a whole column or a whole group.

Definitions (n = count of non-null, non-NaN values, v sorted ascending,
0-based):
  * ``disc``:   v[max(ceil(p*n) - 1, 0)]            (percentile_disc / quantile_disc)
  * ``linear``: h = (n-1)*p; v[floor h] + (h - floor h) * (v[ceil h] - v[floor h])
                                                       (percentile / quantile_cont / numpy default)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.layout import pin, stage_table
from quire.operators.ranking import _partitions


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns, null equal to null; the keys appear once."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


#: The summary's ranks are off by at most n / ACCURACY.
ACCURACY = 10_000
#: Half-widths of the brackets, as shares of the rows. The least one that covers the summary's error and two ranks is taken.
HALF_WIDTHS = (2.5e-4, 1e-3, 1e-2, 1e-1, 1.0)


def _inside_brackets(base: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """(by..., _v, _lump, _w): values that may hold a target rank with their multiplicities, and for each gap between
    brackets one lump with the number of rows in it, placed right after the values below it."""
    edges = [(max(0.0, p - w), min(1.0, p + w)) for p in probs for w in HALF_WIDTHS]
    asked = sorted({e for pair in edges for e in pair})
    summary = base.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("_n"),
                                    F.percentile_approx("_v", asked, ACCURACY).alias("_q"))
    at = {e: F.col("_q")[i] for i, e in enumerate(asked)}

    def edge(p: float, sign: int) -> Column:
        far = float("inf") * sign  # at the ends of the ranks the bracket is open
        picked = F.lit(far)
        for w in reversed(HALF_WIDTHS):
            e = p + sign * w
            value = at[e] if 0 < e < 1 else F.lit(far)
            picked = F.when(F.lit(w) >= 1 / ACCURACY + 2 / F.greatest(F.col("_n"), F.lit(1.0)), value).otherwise(picked)
        return picked

    cuts = {f"_{name}{i}": edge(p, sign) for i, p in enumerate(probs) for name, sign in (("lo", -1), ("hi", 1))}
    brackets = summary.select(*by, *[c.alias(name) for name, c in cuts.items()])
    if by:
        # one row per group on the right, written: few groups are then known to be few, and the rows stay where they are, instead
        # of one task sorting all rows of a group
        rows = null_safe_join(base, stage_table(brackets, "brackets"), by)
    else:
        one = brackets.first()  # one row; enters the plan as literals
        rows = base.select("_v", *[F.lit(one[name]).alias(name) for name in cuts])
    v, inside, below = F.col("_v"), F.lit(False), [F.lit(float("-inf"))]
    for i in range(len(probs)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        inside = inside | ((v >= lo) & (v <= hi))
        below.append(F.when(hi < v, hi))
    gap = F.greatest(*below) if len(below) > 1 else below[0]
    rows = rows.select(*by, F.when(inside, v).otherwise(gap).alias("_v"), (~inside).cast("int").alias("_lump"))
    return rows.groupBy(*by, "_v", "_lump").agg(F.count(F.lit(1)).alias("_w"))


def quantiles_long(df: DataFrame, value: str, probs: list[float], method: str = "disc",
                   by: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Rows (by..., p, value): one per group and probability.

    Steps: bracket the target ranks and collapse what lies inside (:func:`_inside_brackets`);
    range-partition and pin (so the partition ids are fixed); per-partition totals (a small table) give each
    partition's rank offset and locate the partitions that hold a target
    rank; only those partitions are ranked row by row.
    """
    if method not in ("disc", "linear"):
        raise ValueError("method must be 'disc' or 'linear'")
    by = list(by or [])
    v = F.col(value).cast("double")
    base = df.select(*[F.col(b) for b in by], v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    vc = _inside_brackets(base, [float(p) for p in probs], by)
    p_count = _partitions(vc, partitions)
    order = [F.col(b) for b in by] + [F.col("_v"), F.col("_lump")]
    staged = pin(vc.repartitionByRange(p_count, *order).withColumn("_pid", F.spark_partition_id()))

    # per (partition, group): size, offset of its first rank, group total
    parts = staged.groupBy("_pid", *by).agg(F.sum("_w").alias("_part"))
    grp = Window.partitionBy(*by)
    parts = parts.select(
        "_pid", *by, "_part",
        F.coalesce(F.sum("_part").over(grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_part").over(grp).alias("_total"))

    n = F.col("_total").cast("double")
    targets = []
    for p in probs:
        pl = F.lit(float(p))
        if method == "disc":
            targets.append(F.struct(pl.alias("p"), F.lit("x").alias("kind"),
                                    F.greatest(F.ceil(pl * n) - 1, F.lit(0)).cast("bigint").alias("idx"),
                                    F.lit(0.0).alias("frac")))
        else:
            h = (n - 1) * pl
            for kind, idx in (("lo", F.floor(h)), ("hi", F.ceil(h))):
                targets.append(F.struct(pl.alias("p"), F.lit(kind).alias("kind"), idx.cast("bigint").alias("idx"),
                                        (h - F.floor(h)).alias("frac")))
    inside = F.filter(F.array(*targets),
                      lambda t: (t["idx"] >= F.col("_off")) & (t["idx"] < F.col("_off") + F.col("_part")))
    tgt = (parts.select("_pid", *by, "_off", F.explode(inside).alias("t"))
                .select("_pid", *by, "t.p", "t.kind", "t.frac", (F.col("t.idx") - F.col("_off")).alias("_lidx")))
    chunks = tgt.select("_pid", *by).distinct()
    if not by:  # at most 2 x len(probs) rows
        tgt, chunks = F.broadcast(tgt), F.broadcast(chunks)

    rows = null_safe_join(staged, chunks, ["_pid", *by], "left_semi")
    run = Window.partitionBy("_pid", *by).orderBy("_v", "_lump").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_local", F.coalesce(F.sum("_w").over(run), F.lit(0)))
    picked = null_safe_join(rows, tgt, ["_pid", *by]).where(
        (F.col("_lidx") >= F.col("_local")) & (F.col("_lidx") < F.col("_local") + F.col("_w")))
    # the summary's error bound rules a rank in a lump out
    picked = picked.withColumn("_v", F.when(F.col("_lump") == 0, F.col("_v")).otherwise(
        F.raise_error("quantile bracket misses its rank").cast("double")))
    if method == "disc":
        return picked.groupBy(*by, "p").agg(F.min("_v").alias("value"))
    agg = picked.groupBy(*by, "p").agg(
        F.min(F.when(F.col("kind") == "lo", F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("kind") == "hi", F.col("_v"))).alias("_hi"),
        F.first("frac").alias("_frac"))
    return agg.select(*by, "p", (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias("value"))


def quantiles_wide(df: DataFrame, value: str, probs: dict[str, float], method: str = "disc",
                   by: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """One row per group, one column per named probability."""
    by = list(by or [])
    long = quantiles_long(df, value, list(probs.values()), method, by, partitions)
    cols = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(name) for name, p in probs.items()]
    if by:
        return long.groupBy(*by).agg(*cols)
    return long.agg(*cols)
