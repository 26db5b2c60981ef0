"""Phrase collocations from word-level FM-indexes, one per shard of text.

Each task turns its texts into shards of about a million words per language and writes a bidirectional index of each: the
Burrows-Wheeler transforms of the word ids read forwards and backwards, sorted by as many words as the longest phrase has, which is
as deep as intervals are extended. All phrases of a shard are enumerated level by level, by extending every interval one
word to the right (in the backward transform) and to the left (in the forward one) in turn; both intervals of a phrase are kept, their
width is its count. Counts are summed across shards in two steps: first short hashes with counts up to the threshold
(``tally``) tell which phrases can reach the threshold at all; then the shards give the words of those, and Spark sums them exactly. A
hash that stands for several phrases only lets some rare phrases through to the exact sum."""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import tally
from quire.llm.common import mix, staged, text_of
from quire.operators.ranking import top_k_per_group

SHARD_WORDS = 1 << 20
PART_BYTES = 1 << 20

_STOP = 0xFF  # occurs in no UTF-8 text
_LETTERS = bytearray(range(256))
_LETTERS[0x41:0x5B] = range(0x61, 0x7B)
_LETTERS[9] = 32
for _b in (*b".,;:!?", 10, 11, 12, 13):
    _LETTERS[_b] = _STOP
_LETTERS = bytes(_LETTERS)
_EDGE = re.compile(rb"[\x20\x09-\x0D.,;:!?]")


# --- the index of one shard ----------------------------------------------------------------------

def _transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of ``ids`` by contexts of ``depth`` words that end at a separator (0)."""
    key, open_, wide = ids.astype(np.int64), ids != 0, int(ids.max()) + 1
    span = wide
    for d in range(1, depth):
        after = np.zeros(len(ids), np.int64)
        after[:-d] = ids[d:]
        after[~open_] = 0
        open_ = after != 0
        if span > (1 << 62) // wide:
            distinct, key = np.unique(key, return_inverse=True)
            span = len(distinct)
        key = key * wide + after
        span *= wide
    return ids[np.argsort(key, kind="stable") - 1]


class BiIndex:
    """Both transforms of a shard, and intervals of all phrases of a length in both orders."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.symbols = (forward, backward)
        self.rows = [np.argsort(s, kind="stable") for s in self.symbols]  # row reached by each last-to-first step
        self.sizes = np.bincount(forward)
        first = np.cumsum(self.sizes) - self.sizes
        n = len(self.sizes) - 1
        self.words = np.arange(1, n + 1)[:, None]
        self.counts = self.sizes[1:]
        self.starts = [first[1:].copy(), first[1:].copy()]

    def extend(self, left: bool) -> None:
        """Replace each phrase by its extensions by one word to the left or to the right that occur."""
        near, far = (0, 1) if left else (1, 0)
        of_row = np.full(len(self.symbols[near]), -1)
        order = np.argsort(self.starts[near], kind="stable")
        of_row[_ranges(self.starts[near][order], self.counts[order])] = np.repeat(order, self.counts[order])
        came = self.rows[near]
        parent, symbol = of_row[came], self.symbols[near][came]
        at = np.flatnonzero((parent >= 0) & (symbol > 0))
        parent, symbol = parent[at], symbol[at]
        new = np.ones(len(at), bool)
        new[1:] = (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(at)))
        parent, symbol, near_start = parent[first], symbol[first], at[first]
        # the other interval: occurrences beside smaller words come first, those beside a separator before all
        inside = np.bincount(parent, counts, minlength=len(self.counts)).astype(np.int64)
        by_parent = np.argsort(parent, kind="stable")
        running = np.cumsum(counts[by_parent]) - counts[by_parent]
        owner = parent[by_parent]
        head = np.ones(len(owner), bool)
        head[1:] = owner[1:] != owner[:-1]
        running = running - running[head][np.cumsum(head) - 1]
        far_start = np.empty(len(first), np.int64)
        far_start[by_parent] = self.starts[far][owner] + self.counts[owner] - inside[owner] + running
        word = symbol[:, None]
        self.words = np.hstack([word, self.words[parent]] if left else [self.words[parent], word])
        self.counts = counts
        self.starts[near], self.starts[far] = near_start, far_start

    def levels(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word ids, counts) of all phrases of 1, 2, ... ``depth`` words."""
        yield self.words, self.counts
        for d in range(2, depth + 1):
            if not len(self.counts):
                return
            self.extend(left=d % 2 == 1)
            yield self.words, self.counts


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of every pair, in a row."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class _Shard:
    """Word ids of texts in one language, separated by 0, until they are indexed."""

    def __init__(self, depth: int, carried: list[bytes] = ()):
        self.depth, self.carried = depth, len(carried)
        self.code = defaultdict(count().__next__)
        self.code[bytes([_STOP])]
        self.ids = array("i", [0])
        self.ids.extend(map(self.code.__getitem__, carried))

    def add(self, part: bytes) -> None:
        stop = bytes([_STOP])
        self.ids.extend(map(self.code.__getitem__, part.translate(_LETTERS).replace(stop, b" " + stop + b" ").split()))

    def open_words(self) -> list[bytes]:
        """The last words of a piece that goes on in the next shard: phrases that cross the cut are counted there."""
        tail = self.ids[max(1, len(self.ids) - self.depth + 1):].tolist()
        tail = tail[max((i + 1 for i, x in enumerate(tail) if x == 0), default=0):]
        names = list(self.code) if tail else []
        return [names[x] for x in tail]

    def row(self, lang: str, name: int) -> dict:
        ids = np.append(np.frombuffer(self.ids, np.int32), np.int32(0))
        return {"lang": lang, "shard": name, "n": int(np.count_nonzero(ids)) - self.carried, "carried": self.carried,
                "lead": ids[1:1 + self.carried].tobytes(), "words": zstandard.compress(bytes([_STOP]).join(list(self.code)[1:])),
                "forward": _packed(_transform(ids, self.depth)), "backward": _packed(_transform(ids[::-1], self.depth))}


_INDEX = ("lang string, shard long, n long, carried int, lead binary, words binary, forward binary, backward binary")


def shards(docs: DataFrame, depth: int, lang: str = "lang", text: str = "text", shard_words: int = SHARD_WORDS,
           part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per shard: its language, number of words, vocabulary and both transforms. Texts are read part by part."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, open_ = TaskContext.get().partitionId(), count(), {}

        def closed(key: str) -> pa.RecordBatch:
            row = open_.pop(key).row(key, (task << 32) + next(number))
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for key, raw in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                raw, at = raw.as_py(), 0
                while at < len(raw):
                    edge = _EDGE.search(raw, min(at + part_bytes, len(raw)))
                    end = edge.start() if edge else len(raw)
                    if key not in open_:
                        open_[key] = _Shard(depth)
                    open_[key].add(raw[at:end])
                    at = end
                    if len(open_[key].ids) > shard_words:
                        rest = open_[key].open_words() if at < len(raw) else []
                        yield closed(key)
                        if rest:
                            open_[key] = _Shard(depth, rest)
                if key in open_:
                    open_[key].ids.append(0)
                if sum(len(s.ids) for s in open_.values()) > 2 * shard_words:
                    yield closed(max(open_, key=lambda k: len(open_[k].ids)))
        for key in sorted(open_):
            yield closed(key)

    schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("n", pa.int64()), ("carried", pa.int32()), ("lead", pa.binary()),
                        ("words", pa.binary()), ("forward", pa.binary()), ("backward", pa.binary())])
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    return rows.mapInArrow(scan, _INDEX)


def _packed(ids: np.ndarray) -> bytes:
    """Compressed byte by byte of the ids, as the upper bytes vary little."""
    return zstandard.compress(np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _opened(row: dict) -> tuple[list[bytes], BiIndex]:
    """Words by id (the separator first) and the index of a shard."""
    words = zstandard.decompress(row["words"])
    return ([b""] + (words.split(bytes([_STOP])) if words else []),
            BiIndex(_unpacked(row["forward"]), _unpacked(row["backward"])))


def _hashes(words: np.ndarray, of_word: np.ndarray, lang: str) -> np.ndarray:
    out = np.full(len(words), xxhash.xxh64_intdigest(lang, words.shape[1]), np.uint64)
    for d in range(words.shape[1]):
        out = mix(out * np.uint64(3) + of_word[words[:, d]])
    return out


def _of_words(names: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64)


# --- sums across shards --------------------------------------------------------------------------

def _tallied(depth: int, bits: int, cap: int):
    """The hashes of all phrases of each shard, with their counts."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in tally.each(batches):
            names, found = _opened(row)
            of_word = _of_words(names)
            hashes, counts = (np.concatenate(x) for x in zip(*[(_hashes(w, of_word, row["lang"]), c) for w, c in found.levels(depth)]))
            order = np.argsort(hashes)
            yield tally.packed(row["shard"], hashes[order], counts[order], bits, cap)
    return rows


def _given(depth: int, bits: int):
    """The phrases of each shard whose hashes came back, in words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in tally.each(batches):
            names, found = _opened(row)
            of_word, answers = _of_words(names), tally.Answers(row["answers"], bits)
            lead = np.frombuffer(row["lead"], np.int32)
            for words, counts in found.levels(depth):
                hit = answers.holds(_hashes(words, of_word, row["lang"]), "often")
                words, counts = words[hit], counts[hit]
                d = words.shape[1]
                twice = [lead[i:i + d] for i in range(len(lead) - d + 1)]  # counted in the shard before
                phrases = [b" ".join(map(names.__getitem__, w)) for w in [*words.tolist(), *twice]]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([row["lang"]] * len(phrases), pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                    "words": pa.array([d] * len(phrases), pa.int32()),
                    "a": pa.array([*counts.tolist(), *[-1] * len(twice)], pa.int64())})
    return rows


def phrase_counts(docs: DataFrame, depth: int = 3, min_count: int = 10, lang: str = "lang", text: str = "text",
                  shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a), (lang, n)): all phrases of 1 to ``depth`` words that occur ``min_count`` times or more, joined
    by blanks, with their counts, and the number of words of each language. Empty table: no rows."""
    index = staged(shards(docs, depth, lang, text, shard_words), "phrase-index")
    totals = index.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    n = index.agg(F.sum("n")).first()[0] or 0
    bits, cap = tally.range_bits(n * depth), min_count
    answers = tally.frequent(index.select("lang", "shard", "words", "forward", "backward").mapInArrow(
        _tallied(depth, bits, cap), tally.ROWS), min_count, cap).withColumnRenamed("block", "shard")
    rows = index.select("lang", "shard", "lead", "words", "forward", "backward").join(answers, "shard") \
        .mapInArrow(_given(depth, bits), "lang string, phrase string, words int, a long")
    found = rows.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    return staged(found, "phrases"), totals


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, k: int = 2000, lang: str = "lang",
                 text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``k`` phrases of 2 to ``max_words`` words of each language that stick together most.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at blanks and tabs. Cutting a phrase of ``a``
    occurrences into parts of ``l`` and ``r`` scores floor(1000000 a a / (l r)); the least score over the cuts counts, ties to the
    earliest cut. A phrase is left out if a longer one of ``min_count`` occurrences contains it and occurs at least ``share`` per cent as
    often. Products are exact decimals (counts below 10**15). Null texts are empty, null languages ``und``; languages with nothing to
    report and empty tables give no rows."""
    grams, totals = phrase_counts(docs, max_words, min_count, lang, text, shard_words)
    phrases = grams.where("words > 1")
    part = lambda start, size: F.array_join(F.slice(F.split("phrase", " "), start, size), " ")
    inner = [(d, s) for d in range(2, max_words) for s in range(1, max_words - d + 2)]  # sizes and places of shorter phrases
    if inner:
        held = phrases.select("lang", "a", F.explode(F.array(*[F.when((F.col("words") > d) & (F.col("words") >= s + d - 1), part(s, d))
                                                               for d, s in inner])).alias("phrase")).where("phrase IS NOT NULL")
        held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        phrases = phrases.join(held, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).drop("longer")
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("cut")).withColumns(
        {"first": F.expr("array_join(slice(split(phrase, ' '), 1, cut), ' ')"),
         "rest": F.expr("array_join(slice(split(phrase, ' '), cut + 1, size(split(phrase, ' ')) - cut), ' ')")})
    of = lambda part, count: grams.select("lang", F.col("phrase").alias(part), F.col("a").alias(count))
    scored = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    big = lambda c: F.col(c).cast("decimal(19,0)")
    scored = scored.withColumn("top", (big("a") * big("a") * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)")) \
        .withColumn("below", (big("l") * big("r")).cast("decimal(38,0)")).withColumn("score", F.expr("top div below"))
    least = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least")) \
        .select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    ranked = top_k_per_group(least, ["lang"], [F.desc("score"), F.desc("a")], k, ["phrase"])
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
