"""Which hashes occur often over all blocks of a corpus, told to each block that holds them.

Every block sends its distinct hashes, cut to four bytes, with capped counts, packed into one row per hash range. A range is one group:
it adds the counts and answers each block with the hashes that reach a threshold. The number of ranges grows with the
corpus, so a range holds about a million hashes at every size and some 2 in 10,000 share their range and four bytes with another:
an answer may hold a hash too many, never one too few, and callers check what they keep."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix

HASH_BYTES = 4
ROWS = "bucket int, block long, hashes binary, counts binary"
_ANSWER = "bucket int, block long, often binary, heavy binary"


def range_bits(hashes: float, per_range: int = 1 << 20) -> int:
    """Bits of a hash that name its range, so that a range holds about ``per_range`` of ``hashes`` hashes."""
    return int(hashes // per_range).bit_length()


def _kind(cap: int) -> str:
    return "<u1" if cap < 256 else "<u4"


def packed(block: int, hashes: np.ndarray, counts: np.ndarray, bits: int, cap: int) -> pa.RecordBatch:
    """Rows of distinct ascending ``hashes`` with their counts (at most ``cap`` each), one per hash range."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    cuts = np.append(np.searchsorted(hashes, edges), len(hashes))
    low = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    counts = np.minimum(counts, cap).astype(_kind(cap))
    full = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), block), pa.int64()),
        "hashes": pa.array([low[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary()),
        "counts": pa.array([counts[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary())})


def _widened(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :HASH_BYTES] = raw
    return wide.view(np.uint64).ravel()


def frequent(rows: DataFrame, least: int, cap: int, heavy: int | None = None) -> DataFrame:
    """(block, answers): per block, the hashes whose total is ``least`` or more, and those whose total is over ``heavy``.

    ``cap`` is the one the rows were packed with, at least ``least`` and ``heavy``."""
    none = np.empty(0, np.uint8)

    def add(table: pa.Table) -> pa.Table:
        parts = table["hashes"].to_pylist()
        sizes = np.array([len(p) // HASH_BYTES for p in parts])
        values = _widened(parts)
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), _kind(cap))
        order = np.argsort(values, kind="stable")
        first = np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))
        total = np.empty(len(values), np.int64)
        total[order] = np.repeat(np.add.reduceat(counts[order].astype(np.int64), first), np.diff(np.append(first, len(values))))
        out, at = {"block": [], "often": [], "heavy": []}, 0
        for block, size, part in zip(table["block"].to_pylist(), sizes, parts):
            mine = total[at:at + size]
            at += size
            if (mine >= least).any():
                raw = np.frombuffer(part, np.uint8).reshape(-1, HASH_BYTES)
                out["block"].append(block)
                out["often"].append(raw[mine >= least].tobytes())
                out["heavy"].append((none if heavy is None else raw[mine > heavy]).tobytes())
        return pa.table({"bucket": pa.array([table["bucket"][0].as_py()] * len(out["block"]), pa.int32()),
                         "block": pa.array(out["block"], pa.int64()), "often": pa.array(out["often"], pa.binary()),
                         "heavy": pa.array(out["heavy"], pa.binary())})

    found = rows.groupBy("bucket").applyInArrow(add, _ANSWER)
    return found.groupBy("block").agg(F.collect_list(F.struct("bucket", "often", "heavy")).alias("answers"))


def _key(low: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return mix(low ^ (bucket << np.uint64(8 * HASH_BYTES)) ^ (bucket * np.uint64(0x9E3779B97F4A7C15)))


class Answers:
    """The answers a block got, to be asked for whole hashes."""

    def __init__(self, answers: list[dict], bits: int):
        self.bits = bits
        self.keys = {}
        for name in ("often", "heavy"):
            sizes = [len(a[name]) // HASH_BYTES for a in answers]
            bucket = np.repeat(np.array([a["bucket"] for a in answers], np.uint64), sizes)
            self.keys[name] = np.unique(_key(_widened([a[name] for a in answers]), bucket))

    def holds(self, hashes: np.ndarray, name: str) -> np.ndarray:
        bucket = hashes >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(hashes), np.uint64)
        keys, asked = self.keys[name], _key(hashes & np.uint64((1 << 8 * HASH_BYTES) - 1), bucket)
        return keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked if len(keys) else np.zeros(len(asked), bool)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that a wide one does not wait for others."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
