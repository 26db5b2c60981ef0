"""Helpers shared by the text operators: tables, staging, word scanning in numpy.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` (ASCII white space), the
definition every contract of this subpackage uses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLAB_BYTES = 1 << 20  # text bytes scanned by one round of numpy calls

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a table every executor can read, so a lost executor costs a re-read, and
    later uses neither recompute nor reorder the rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


# --- numpy word scanning -------------------------------------------------------------------------

def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte buffer."""
    space = np.ones(len(buf) + 2, np.int8)
    space[1:-1] = _IS_SPACE[buf]
    edge = np.diff(space)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def segments(text: bytes, overlap: int, limit: int = SLAB_BYTES) -> Iterator[tuple[int, bool, bytes]]:
    """Cut a text at word boundaries into (index of the first word, is it the last segment, bytes) of about ``limit`` bytes.

    Each segment repeats the last ``overlap`` words before it, so every window of ``overlap + 1``
    words lies inside exactly one segment; memory stays bounded for texts of any length."""
    if len(text) <= limit:
        yield 0, True, text
        return
    base, start, carry = 0, 0, []
    while start < len(text):
        cut = _SPACE.search(text, min(start + limit, len(text)))
        end = cut.start() if cut else len(text)
        words = carry + text[start:end].split()
        yield base, end == len(text), b" ".join(words)
        carry = words[-overlap:] if overlap else []
        base += len(words) - len(carry)
        start = end


def slabs(texts: list[bytes], overlap: int, limit: int = SLAB_BYTES) -> Iterator[tuple[np.ndarray, list, list]]:
    """Join the segments of many texts into byte buffers of about ``limit`` bytes.

    Yields (buffer, offset of each segment, (text index, first word, is it the text's last) of each segment)."""
    parts, starts, owners, size = [], [], [], 0
    for i, text in enumerate(texts):
        for base, last, part in segments(text, overlap, limit):
            if parts and size + len(part) > limit:
                yield np.frombuffer(b"\n".join(parts), np.uint8), starts, owners
                parts, starts, owners, size = [], [], [], 0
            starts.append(size)
            owners.append((i, base, last))
            parts.append(part)
            size += len(part) + 1
    if parts:
        yield np.frombuffer(b"\n".join(parts), np.uint8), starts, owners


_MULT = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_MULT_INV = pow(_MULT, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _MULT, np.uint64), np.full(size, _MULT_INV, np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 4 * SLAB_BYTES:
            _powers[0] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the public splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes modulo 2**64 of ``values[start:end]``, from one running sum.

    The hash of a slice depends on its content alone, not on where it stands."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return rolling(buf.astype(np.uint64) + np.uint64(1), starts, ends)


def other_word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of the words, from scrambled (byte, place in the word) pairs instead of powers."""
    first = np.zeros(len(buf), np.int64)
    first[starts] = starts
    place = (np.arange(len(buf)) - np.maximum.accumulate(first)).astype(np.uint64)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(mix((place << np.uint64(8)) + buf + np.uint64(1)), out=sums[1:])
    return mix(sums[ends] - sums[starts])
