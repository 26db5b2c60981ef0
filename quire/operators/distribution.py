"""Data behind distribution charts: histograms, 2-D grids, densities, box stats.

Bounds (min, max, n, std) are one small aggregation each, handed to the rows
as scalar subqueries; binning is a projection plus a grouped count, so the
output is sized by the number of bins, never by the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.quantile import null_safe_join, quantiles_wide

# Cells are half a bandwidth wide, so values lie within 1/4 bandwidth of a centre and the Hermite series of their kernels,
# cut after 12 terms, is off by less than 1.1 * 0.25 ** 12 / sqrt(12!) < 1e-11 each (Cramer's bound on Hermite functions).
# Beyond 10 bandwidths a kernel is below 1e-21 of its peak.
CELL = 0.5
HERMITE_TERMS = 12
KERNEL_REACH = 10.0


def _edges(lo: Column, hi: Column) -> tuple[Column, Column]:
    """Equal bounds get a unit-wide range around them (numpy's rule)."""
    same = lo == hi
    return (F.when(same, lo - 0.5).otherwise(lo), F.when(same, hi + 0.5).otherwise(hi))


def bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of ``v`` in [lo, hi]; the last bin is closed."""
    raw = F.floor((v - lo) / (hi - lo) * bins).cast("int")
    return F.least(raw, F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int, range_: tuple[float, float] | None = None) -> DataFrame:
    """(bin, lower, upper, count) for ``bins`` equal-width bins over min..max
    (or ``range_``, values outside dropped); empty bins are listed with 0. Null, NaN and infinite values are left out."""
    spark = df.sparkSession
    v = F.col(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf")))
    if range_ is not None:
        lo, hi = F.lit(float(range_[0])), F.lit(float(range_[1]))
        vals = vals.where(F.col("v").between(lo, hi))
    else:
        b = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    lo, hi = _edges(lo, hi)
    binned = vals.select(bin_index(F.col("v"), lo, hi, bins).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins
    frame = spark.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    frame = frame.select("bin", (lo + F.col("bin") * width).alias("lower"), (lo + (F.col("bin") + 1) * width).alias("upper"))
    # an empty input has no bounds: no bins at all
    frame = frame.where(lo.isNotNull())
    return frame.join(counts, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def grid_density(df: DataFrame, x: str, y: str, nx: int = 20, ny: int = 20, by: list[str] | None = None) -> DataFrame:
    """Counts per non-empty cell of an nx x ny grid over the x and y ranges -
    a bounded stand-in for a scatter plot of every row (optionally per ``by``
    group, e.g. cluster, on shared axes)."""
    by = list(by or [])
    vals = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop(
        how="any", subset=["x", "y"])
    b = vals.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    x0, x1 = _edges(b.select("x0").scalar(), b.select("x1").scalar())
    y0, y1 = _edges(b.select("y0").scalar(), b.select("y1").scalar())
    binned = vals.select(*by, bin_index(F.col("x"), x0, x1, nx).alias("x_bin"),
                         bin_index(F.col("y"), y0, y1, ny).alias("y_bin"))
    return binned.groupBy(*by, "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


def kde(df: DataFrame, col: str, grid: int = 200, by: list[str] | None = None,
        bw_factor: float | None = None) -> DataFrame:
    """Gaussian kernel density on ``grid`` even points from min to max.

    Bandwidth = factor * sample std, factor = n ** (-1/5) (Scott's rule) unless
    given. One aggregation turns the values into moments of cells half a bandwidth wide; the kernel of all
    values of a cell is then a truncated Hermite series in those moments (a fast Gauss transform). Each
    density is off by less than 1e-11 / bandwidth (``HERMITE_TERMS``, ``KERNEL_REACH``). A group has at most
    40 x grid (cell, point) pairs, however many values it holds. Output (by..., point, x, density).
    """
    by = list(by or [])
    v = F.col(col).cast("double")
    vals = df.select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    st = vals.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                                F.min("v").alias("lo"), F.max("v").alias("hi"))
    factor = F.lit(bw_factor) if bw_factor is not None else F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = st.withColumn("h", factor * F.col("sd")).withColumn(
        "step", F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / (grid - 1)).otherwise(F.lit(1.0)))
    if by:
        j = null_safe_join(vals, st, by)  # one row per group on the right; null is a group too
    else:
        one = {c: st.select(c).scalar() for c in ("n", "sd", "lo", "hi", "h", "step")}  # merged into one subquery
        j = vals.select("*", *[v.alias(c) for c, v in one.items()])
    h, lo, step = F.col("h"), F.col("lo"), F.col("step")
    j = j.where(h > 0).withColumn("cell", F.floor((F.col("v") - lo) / (CELL * h)))
    off = (F.col("v") - lo) / h - (F.col("cell") + 0.5) * CELL  # from the centre of the cell, in bandwidths
    moments = [F.sum(_power(off, k)).alias(f"m{k}") for k in range(HERMITE_TERMS)]
    cells = j.groupBy(*by, "cell").agg(*[F.first(c).alias(c) for c in ("n", "h", "lo", "step")], *moments)
    centre = (F.col("cell") + 0.5) * CELL * h  # above lo
    first = F.greatest(F.ceil((centre - KERNEL_REACH * h) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((centre + KERNEL_REACH * h) / step), F.lit(grid - 1)).cast("int")
    names = [f"m{k}" for k in range(HERMITE_TERMS)]
    # a cell between two grid points of a coarse grid may reach none
    pts = cells.where(first <= last).select(*by, "n", "h", *names, "step", centre.alias("centre"),
                                            F.explode(F.sequence(first, last)).alias("point"))
    t = (F.col("point") * step - F.col("centre")) / h
    series, below, this = F.col("m0"), F.lit(0.0), F.lit(1.0)
    pts = pts.withColumn("t", t)
    for k in range(1, HERMITE_TERMS):  # He_k(t) = t He_{k-1}(t) - (k - 1) He_{k-2}(t)
        pts = pts.withColumn(f"he{k}", F.col("t") * this - (k - 1) * below)
        below, this = this, F.col(f"he{k}")
        series = series + this * F.col(f"m{k}") / math.factorial(k)
    term = F.exp(-0.5 * F.col("t") * F.col("t")) * series / (F.col("n") * h * math.sqrt(2 * math.pi))
    sums = pts.groupBy(*by, "point").agg(F.sum(term).alias("density"))
    # every grid point is listed, 0 where no value reaches it
    if by:
        frame = st.where(F.col("h") > 0).select(*by, "lo", "step",
                                                 F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    else:
        frame = df.sparkSession.range(grid, numPartitions=1).select(
            one["lo"].alias("lo"), one["step"].alias("step"), F.col("id").cast("int").alias("point")).where(one["h"] > 0)
    frame = frame.select(*by, "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"))
    out = null_safe_join(frame, sums, [*by, "point"], "left")
    return out.select(*by, "point", "x", F.coalesce(F.col("density"), F.lit(0.0)).alias("density"))


def _power(x: Column, k: int) -> Column:
    """x to the k by multiplication; 1 for k = 0."""
    out = F.lit(1.0)
    for _ in range(k):
        out = out * x
    return out


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: count, min, q1, median, q3, max (interpolated quantiles) -
    the box inside a violin plot; the density part is :func:`kde` with ``by``."""
    src = df.where(F.col(group).isNotNull())
    v = F.col(value).cast("double")
    basic = src.where(v.isNotNull() & ~F.isnan(v)).groupBy(group).agg(
        F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"))
    q = quantiles_wide(src, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, method="linear", by=[group])
    return basic.join(q, group).select(group, "count", "min", "q1", "median", "q3", "max")
