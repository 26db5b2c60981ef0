"""Row sampling and train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the keyed (stable) sampler: bucket = ((key mod M) * A + seed) mod M.
HASH_MODULUS = 1000003
HASH_MULTIPLIER = 7919


def stable_bucket(key: str | Column, seed: int) -> Column:
    """Deterministic pseudo-random bucket in [0, HASH_MODULUS) from an integer key.

    Plain integer arithmetic, so the same split can be written in any SQL
    engine, and it does not change with the partitioning of the input.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k.cast("bigint"), F.lit(HASH_MODULUS)) * HASH_MULTIPLIER + F.lit(int(seed)),
                  F.lit(HASH_MODULUS))


def _bucket(df: DataFrame, key: str, seed: int) -> Column:
    """Bucket of any key type: integers by :func:`stable_bucket` (any SQL engine can repeat it), others by
    a 64-bit hash. A null key has a bucket like any other key, so no row is lost."""
    if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        mixed = stable_bucket(key, seed)
    else:
        mixed = F.pmod(F.xxhash64(F.lit(int(seed)), F.col(key)), F.lit(HASH_MODULUS))
    return F.coalesce(mixed, F.lit((int(seed) * HASH_MULTIPLIER) % HASH_MODULUS))


def bernoulli(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """Sample without replacement. With ``key`` the choice is a stable hash
    of the key; without, Spark's per-partition sampler (depends on layout)."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(_bucket(df, key, seed) < F.lit(int(round(fraction * HASH_MODULUS))))


def split(df: DataFrame, weights: list[float], seed: int, key: str | None = None) -> list[DataFrame]:
    """Split by normalised ``weights``; keyed splits are stable, unkeyed use randomSplit."""
    if key is None:
        return df.randomSplit(weights, seed)
    total = float(sum(weights))
    b = _bucket(df, key, seed)
    out, acc = [], 0.0
    for w in weights:
        lo = int(round(acc / total * HASH_MODULUS))
        acc += w
        hi = int(round(acc / total * HASH_MODULUS))
        out.append(df.where((b >= lo) & (b < hi)))
    return out


def split_label(df: DataFrame, weights: dict[str, float], seed: int, key: str, name: str = "split") -> DataFrame:
    """Tag each row with its split name (one pass instead of one filter per split)."""
    total = float(sum(weights.values()))
    b = _bucket(df, key, seed)
    expr, acc = None, 0.0
    for label, w in weights.items():
        acc += w
        hi = int(round(acc / total * HASH_MODULUS))
        expr = F.when(b < hi, F.lit(label)) if expr is None else expr.when(b < hi, F.lit(label))
    return df.withColumn(name, expr)
