"""Cleaning: drops, fills, safe casts, CASE labels, outlier bounds, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scalar import safe_cast as _safe_cast
from quire.operators.quantile import quantiles_long, quantiles_wide


def drop_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the named columns that exist; absent names are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def require(df: DataFrame, subset: list[str]) -> DataFrame:
    """Keep rows whose key columns are all non-null (pushed to the scan as IsNotNull)."""
    return df.dropna(how="any", subset=subset)


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Project ``cols`` and drop rows with any null or NaN among them."""
    out = df.select(*cols) if cols else df
    return out.na.drop(how="any")


def safe_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; text that does not parse becomes null instead of failing."""
    return df.withColumns({c: _safe_cast(c, t) for c, t in types.items()})


def fill(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace null by a constant per column (NaN is left alone).

    A text default turns a column of another type into text, as a CASE with both would."""
    types = dict(df.dtypes)

    def filled(c: str, v: object) -> Column:
        old = F.col(c).cast("string") if isinstance(v, str) and types[c] != "string" else F.col(c)
        return F.coalesce(old, F.lit(v))

    return df.withColumns({c: filled(c, v) for c, v in defaults.items()})


def case_label(value: Column, rules: list[tuple[Column, object]], default: object) -> Column:
    """First matching (condition, label) wins, else ``default``."""
    cond, lab = rules[0]
    expr = F.when(cond, F.lit(lab))
    for cond, lab in rules[1:]:
        expr = expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def score_label(score: str = "score", threshold: float = 4.0, pos: str = "positive", neg: str = "negative",
                drop_null_label: bool = False) -> Column:
    """Binary label: score >= threshold -> pos, anything else (null included) -> neg.

    ``drop_null_label`` leaves rows without a score without a label."""
    c = F.col(score)
    rules = [(c.isNull(), None)] if drop_null_label else []
    return case_label(c, [*rules, (c >= threshold, pos)], neg)


def quantile_bounds(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """One row (lower, upper): exact rank quantiles (values taken from the data)."""
    return quantiles_wide(df, col, {"lower": lo, "upper": hi}, method="disc")


def _clamp(c: Column, lower: Column, upper: Column) -> Column:
    return F.when(c < lower, lower).when(c > upper, upper).otherwise(c).cast("double")


def winsorize(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Clamp ``col`` to its exact lo/hi quantiles; result double, null stays null.

    The two bounds (one row) are fetched once and enter the plan as literals:
    no join, and later plans that nest this one do not re-run the quantile.
    """
    b = quantile_bounds(df, col, lo, hi).first()  # one row
    lower, upper = (F.lit(b[k]).cast("double") for k in ("lower", "upper"))
    return df.withColumn(col, _clamp(F.col(col).cast("double"), lower, upper))


def clip(df: DataFrame, col: str, lower: float, upper: float) -> DataFrame:
    """Clamp to fixed bounds."""
    return df.withColumn(col, _clamp(F.col(col).cast("double"), F.lit(float(lower)), F.lit(float(upper))))


def upper_cap(df: DataFrame, col: str, p: float = 0.99) -> DataFrame:
    """One row (cap): the interpolated p-quantile of ``col``."""
    return quantiles_wide(df, col, {"cap": p}, method="linear")


def upper_caps(df: DataFrame, cols: list[str], p: float = 0.99) -> DataFrame:
    """One row, one column per name: the interpolated p-quantile of each
    column, all from one grouped pass (columns unpivoted to (column, value))."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value")
    q = quantiles_long(long, "value", [p], method="linear", by=["column"])
    return q.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in cols])


def cap_upper(df: DataFrame, cols: str | list[str], p: float = 0.99) -> DataFrame:
    """Replace values above the interpolated p-quantile by it, per column; result double."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    caps = upper_caps(df, cols, p).first()  # one row, fetched once; enters the plan as literals
    out = {}
    for c in cols:
        cap = F.lit(caps[c]).cast("double")
        v = F.col(c).cast("double")
        out[c] = F.when(v > cap, cap).otherwise(v)
    return df.withColumns(out)


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop identical rows (over ``subset`` if given, else all columns)."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def row_hash(df: DataFrame) -> Column:
    """128 bits of a row's values (two 64-bit hashes), the same for rows that ``distinct`` holds equal."""
    types = dict(df.dtypes)
    # + 0.0 makes -0.0 and 0.0 one value; nulls do not enter xxhash64, so the row says which columns are null
    values = [F.col(c) + F.lit(0).cast(types[c]) if types[c] in ("float", "double") else F.col(c) for c in df.columns]
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    return F.struct(F.xxhash64(nulls, *values).alias("a"), F.xxhash64(F.lit("second"), *values, nulls).alias("b"))


def dedupe_report(df: DataFrame) -> DataFrame:
    """One row (rows_before, rows_after, rows_removed) in a single aggregation that ships 16 bytes per row, however wide."""
    agg = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_distinct(row_hash(df)).alias("rows_after"))
    return agg.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


# Default texts for missing fields of the item and review tables.
ITEM_DEFAULTS = {
    "description": "No Description Available",
    "authors": "Unknown Author",
    "image": "https://example.com/default_image.jpg",
    "previewLink": "No Preview Available",
    "publisher": "Unknown Publisher",
    "publishedDate": "Unknown Date",
    "infoLink": "No Info Available",
    "categories": "Uncategorized",
}
REVIEW_DEFAULTS = {
    "profileName": "Anonymous",
    "review/summary": "No Summary Provided",
    "review/text": "No Review Available",
}


def clean_items(df: DataFrame, key: str = "Title", count_col: str = "ratingsCount",
                defaults: dict[str, object] | None = None, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Item table cleaning (the quantile bounds run when called): safe int cast of the count, drop
    rows without a key, fill missing fields (count -> 0), clamp the count to
    its exact lo/hi quantiles (double), drop identical rows."""
    fills = dict(ITEM_DEFAULTS if defaults is None else defaults)
    fills = {c: v for c, v in fills.items() if c in df.columns}
    out = safe_cast(df, {count_col: "int"})
    out = require(out, [key])
    out = fill(out, {**fills, count_col: 0})
    out = winsorize(out, count_col, lo, hi)
    return dedupe(out)


def clean_reviews(df: DataFrame, keys: list[str] | None = None, drop: list[str] | None = None,
                  time_col: str | None = "review/time", zone: str = "UTC",
                  defaults: dict[str, object] | None = None) -> DataFrame:
    """Review table cleaning: drop unwanted columns if present, add the review
    time as text (``<time_col>_text``), drop rows missing a key, fill missing
    texts, drop identical rows."""
    from quire.functions.scalar import unix_to_text
    keys = keys if keys is not None else ["Title", "User_id"]
    out = drop_existing(df, drop if drop is not None else ["Price", "review/helpfulness"])
    if time_col and time_col in out.columns:
        out = out.withColumn(f"{time_col}_text", unix_to_text(F.col(time_col).try_cast("bigint"), zone))
    out = require(out, keys)
    fills = dict(REVIEW_DEFAULTS if defaults is None else defaults)
    out = fill(out, {c: v for c, v in fills.items() if c in out.columns})
    return dedupe(out)
