"""Best-fit packing of tokenised documents into fixed-length sequences by minimum bin slack.

A sequence holds ``capacity`` tokens, so pieces fall into at most ``capacity`` lengths. The packing is planned on
the histogram of lengths (bounded by the capacity, whatever the corpus): per bin, a bitset subset-sum over the available
lengths finds the fullest feasible combination, which is removed. The same combination stays the fullest as long as its
lengths last, so it is removed as many times as the counts allow in one step. Spark then deals the pieces to the planned places by
their rank among the pieces of equal length."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import segments, staged, text_of

CAPACITY = 2048
END_ID = 0
RANK_ROWS = 4096  # rows ranked by one window group
CACHED_WORDS = 250_000  # per generation; a Python worker holds two
CACHED_JOINS = 100_000  # chunks put together from words, cheap to make again

# Letters whose lower case and composed form are character by character, then plain punctuation: the tokenizer
# splits such a chunk into exactly these two parts.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


class _Words(dict):
    """Ids (little-endian unsigned 32-bit) of a white-space separated chunk, kept while it is in use.

    A chunk of a word and points, or with capitals, is put together from its parts and kept in a small table of its own. A full
    table of words becomes the older generation and an empty one takes over; words met again move up, the others go with it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.older: dict[bytes, bytes] = {}
        self.joined: dict[bytes, bytes] = {}
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.joined.get(chunk)
        if ids is not None:
            return ids
        ids = self.older.get(chunk)
        if ids is None:
            text = chunk.decode("utf-8", "replace")
            simple = _SIMPLE.fullmatch(text)
            if not simple:
                ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                word = simple[1].lower()
                if word != text:
                    ids = self[word.encode()] + (self[simple[2].encode()] if simple[2] else b"")
                    if len(self.joined) >= CACHED_JOINS:
                        self.joined.clear()
                    self.joined[chunk] = ids
                    return ids
                mapped = word if word.isascii() else self.bytes.pre_tokenize_str(word)[0][0]
                ids = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


_words: dict[str, _Words] = {}


def encode(text: bytes, path: str) -> bytes:
    """Token ids of a text, as the tokenizer gives them without special tokens.

    The tokenizer never joins characters across white space, so chunks are encoded by themselves."""
    words = _words.get(path)
    if words is None:
        words = _words[path] = _Words(path)
    return b"".join(b"".join(map(words.__getitem__, part.split())) for _, _, part in segments(text, 0))


def token_pieces(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids): every text's ids and ``end_id``, cut every ``capacity`` tokens.

    ``ids`` is binary, little-endian unsigned 32-bit. ``tokenizer`` is a tokenizer file found on every executor.
    Null and empty texts are the end id alone."""
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ids, size = [], [], [], 0
            for i, raw in enumerate(batch.column("text").cast(pa.binary())):
                tokens = encode(raw.as_py(), tokenizer) + end
                for at in range(0, len(tokens), step):
                    rows.append(i)
                    starts.append(at // 4)
                    ids.append(tokens[at:at + step])
                    size += len(ids[-1])
                if size > 8 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array(rows)), pa.array([s // capacity for s in starts], pa.int32()),
                        pa.array(starts, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary())], names=["id", "piece", "start", "length", "ids"])
                    rows, starts, ids, size = [], [], [], 0

    rows = docs.select(F.col(id_column).alias("id"), text_of(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum bin slack on a histogram of lengths: (times, [(length, uses), ...]) per distinct bin content.

    Ties between fullest combinations go to the one with more of the longest lengths."""
    lengths = sorted(counts)
    left = [counts[x] for x in lengths]
    mask = (1 << (capacity + 1)) - 1
    reach = [1] + [0] * len(lengths)  # reach[i]: sums that lengths[:i] can make

    def extend(first: int) -> None:
        for i in range(first, len(lengths)):
            bits, n, step = reach[i], min(left[i], capacity // lengths[i]), 1
            while n > 0:
                take = min(step, n)
                bits |= (bits << (take * lengths[i])) & mask
                n -= take
                step *= 2
            reach[i + 1] = bits

    extend(0)
    bins = []
    while True:
        rest = reach[-1].bit_length() - 1
        if rest == 0:
            return bins
        used = []
        for i in range(len(lengths) - 1, -1, -1):
            n = min(left[i], rest // lengths[i])
            while not reach[i] >> (rest - n * lengths[i]) & 1:
                n -= 1
            if n:
                used.append((i, n))
                rest -= n * lengths[i]
            if not rest:
                break
        times = min(left[i] // n for i, n in used)
        bins.append((times, [(lengths[i], n) for i, n in used]))
        changed = len(lengths)
        for i, n in used:
            before = min(left[i], capacity // lengths[i])
            left[i] -= times * n
            if min(left[i], capacity // lengths[i]) != before:
                changed = min(changed, i)
        extend(changed)


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add (sequence_id, offset) to pieces that have a ``length`` from 1 to ``capacity``.

    ``order`` names columns that tell pieces apart; pieces equal in all of them are interchangeable. ``pieces`` is staged
    once, so leave wide columns out and join them later. Empty table: no rows."""
    spark = pieces.sparkSession
    rows = staged(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and (min(counts) < 1 or max(counts) > capacity):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    places, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for times, content in plan(counts, capacity):
        offset = 0
        for length, uses in content:
            for _ in range(uses):
                places.append((length, taken[length], taken[length] + times, sequence, offset))
                taken[length] += times
                offset += length
        sequence += times
    # both tables are bounded by the capacity: one row per length, and few planned places per length
    parts = F.broadcast(spark.createDataFrame([(n, -(-c // RANK_ROWS)) for n, c in counts.items()],
                                              "length long, parts long"))
    places = F.broadcast(spark.createDataFrame(
        places, "length long, first long, last long, sequence long, offset long").withColumnRenamed("length", "of"))
    dealt = rows.join(parts, "length").withColumn("part", F.pmod(F.xxhash64(*order), "parts")).drop("parts")
    before = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1) \
        .join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    at = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked.join(places, at).withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first")) \
        .select(*pieces.columns, "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces with ``ids``, ``sequence_id`` and ``offset``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
