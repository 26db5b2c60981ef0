"""Homomorphic multiset fingerprints of documents.

Every paragraph (line) is hashed to a wide vector and the vectors are added lane by lane modulo a power of two, so the
fingerprint does not depend on the paragraphs' order and paragraphs can be inserted or deleted by adding or
subtracting their vectors. The vector has two parts: ``EXACT`` lanes from SHA-512 (modulo 2**16), which tell multisets of
paragraphs apart, and ``LANES`` lanes of signs summed over the paragraph's words and word pairs (modulo 2**32), whose
inner products estimate how much two texts share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SLAB_BYTES, mix, segments, shuffle_partitions, text_of, word_bounds, word_hashes

EXACT = 32
LANES = 64
BUCKETS_PER_TASK = 3


class Fingerprint:
    """A sum of paragraph vectors; ``+`` inserts and ``-`` deletes paragraphs."""

    def __init__(self, exact: np.ndarray, lanes: np.ndarray):
        self.exact, self.lanes = exact, lanes

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.lanes - other.lanes)

    def hex(self) -> str:
        return self.exact.astype(">u2").tobytes().hex() + self.lanes.astype(">u4").tobytes().hex()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw[:2 * EXACT], ">u2").astype(np.uint16),
                   np.frombuffer(raw[2 * EXACT:], ">u4").astype(np.uint32))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the estimated share of words and word pairs in common, 0 to 1."""
        if (self.exact == other.exact).all() and (self.lanes == other.lanes).all():
            return 1.0
        a, b = self.lanes.astype(np.int32).astype(float), other.lanes.astype(np.int32).astype(float)
        size = a @ a + b @ b
        return float(min(1.0, max(0.0, 2 * (a @ b) / size))) if size else 0.0


def _pieces(paragraphs: list[bytes], limit: int) -> Iterator[tuple[bool, bytes]]:
    """(goes on, bytes): whole paragraphs, one per line, of up to about ``limit`` bytes; a longer paragraph is cut into
    segments, each but the first repeating one word (``goes on``). No piece depends on other paragraphs."""
    group, size = [], 0
    for p in paragraphs:
        if group and size + len(p) > limit:
            yield False, b"\n".join(group)
            group, size = [], 0
        if len(p) <= limit:
            group.append(p)
            size += len(p) + 1
            continue
        goes_on = False
        for _, _, part in segments(p, 1, limit):
            yield goes_on, part
            goes_on = goes_on or len(part) > 0  # leading white space leaves no word to repeat
    if group:
        yield False, b"\n".join(group)


def of_paragraphs(paragraphs: list[bytes], limit: int = SLAB_BYTES) -> Fingerprint:
    """The fingerprint of a multiset of paragraphs; ``limit`` bounds the bytes hashed at once, not the result."""
    digests = b"".join(hashlib.sha512(p).digest() for p in paragraphs)
    exact = np.frombuffer(digests, "<u2").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64).astype(np.uint16)
    ones, units = np.zeros(LANES, np.int64), 0
    for goes_on, part in _pieces(paragraphs, limit):
        buf = np.frombuffer(part, np.uint8)
        starts, ends = word_bounds(buf)
        if not len(starts):
            continue
        words = word_hashes(buf, starts, ends)
        line = np.cumsum(buf == 10)[starts]
        together = line[1:] == line[:-1]
        pairs = mix(words[:-1] * np.uint64(3) + words[1:])[together]
        for hashes in (words[1:] if goes_on else words, pairs):
            for at in range(0, len(hashes), 1 << 16):
                block = hashes[at:at + (1 << 16)]
                ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
                units += len(block)
    return Fingerprint(exact, (2 * ones - units).astype(np.uint32))


def of_text(text: str) -> Fingerprint:
    return of_paragraphs(text.encode().split(b"\n"))


def _edit(text: str, mark: Fingerprint, after: str) -> tuple[str, Fingerprint]:
    """The text with its last quarter replaced by the next text's first characters, and its fingerprint, by deleting
    the paragraphs that change and inserting the new ones."""
    quarter = len(text) // 4
    head = text[:len(text) - quarter]
    cut = head.rfind("\n") + 1  # paragraphs before it stay as they are
    new = head[cut:] + after[:quarter]
    return head[:cut] + new, \
        mark - of_paragraphs(text[cut:].encode().split(b"\n")) + of_paragraphs(new.encode().split(b"\n"))


def _neighbours(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows (bucket, extra, id, version, text) so that in each bucket, sorted, every row is followed by the next one.

    Buckets are ranges of ids at approximate quantiles, so any spread of ids makes even buckets. The first row of a
    bucket is repeated (``extra`` = 1) at the end of the bucket before it, and the very first at the end of the last."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), text_of(text).alias("text")) \
        .withColumn("version", F.xxhash64("text"))
    n = BUCKETS_PER_TASK * shuffle_partitions(spark)
    cuts = rows.select(F.col("id").cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.2 / n)
    cuts = np.unique(np.array(cuts, float))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy(dtype=float, na_value=-np.inf)  # null ids come first
        return pd.Series(np.searchsorted(cuts, values, side="right"))

    rows = rows.withColumn("bucket", bucket_of(F.col("id").cast("double")))
    lead = F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "version"))
    firsts = sorted((r["bucket"], r["first"]) for r in
                    rows.groupBy("bucket").agg(lead.alias("first")).collect())  # at most n rows
    table = [(b, firsts[i - 1][0], f["id"], f["version"]) for i, (b, f) in enumerate(firsts)]
    kind = rows.schema["id"].dataType.simpleString()
    firsts = F.broadcast(spark.createDataFrame(table, f"bucket int, before int, first {kind}, first_version long"))
    first = F.col("id").eqNullSafe(F.col("first")) & (F.col("version") == F.col("first_version"))
    own = F.struct(F.col("bucket"), F.lit(0).alias("extra"))
    other = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("extra"))
    placed = rows.join(firsts, "bucket").select(
        F.explode(F.when(first, F.array(own, other)).otherwise(F.array(own))).alias("at"), "id", "version", "text")
    return placed.select("at.bucket", "at.extra", "id", "version", "text")


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the next id, ascending (null ids first, rows of one id by a hash of their text, the first after the
    last). A null text is empty: one empty paragraph. Repeated rows follow each other. A single row is its own next.
    ``edited`` is the SHA-256 of the edited text, lowercase hex. Empty table: no rows. Ids must be numeric."""
    n = shuffle_partitions(docs.sparkSession)
    dealt = _neighbours(docs, id_column, text).repartition(n, "bucket") \
        .sortWithinPartitions("bucket", "extra", F.col("id").asc_nulls_first(), "version")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for bucket, extra, key, text in zip(*(batch.column(c).to_pylist() for c in
                                                  ("bucket", "extra", "id", "text"))):
                if extra and held is None:
                    continue  # a repeated first row
                mark = of_text(text)
                if held is not None and held[0] == bucket:
                    _, at, before, own = held
                    edited, after = _edit(before, own, text)
                    out.append((at, len(before), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), after.hex(),
                                own.likeness(after), own.likeness(mark)))
                held = None if extra else (bucket, key, text, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    kind = dealt.schema["id"].dataType.simpleString()
    names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    types[0] = pa.int64() if kind == "bigint" else None
    return dealt.select("bucket", "extra", "id", "text").mapInArrow(
        scan, f"id {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
