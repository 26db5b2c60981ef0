"""SimHash fingerprints and exact near-duplicate components within a Hamming radius.

Fingerprints: Python scans whole texts in Arrow batches, hashes every shingle with XXH64 and takes the
majority of each bit. Links: the distinct fingerprints are cut into tiles by the bit counts of their
two 32-bit halves; a tile meets only tiles whose counts differ by at most the radius in total (a lower bound of
the Hamming distance), and numpy compares the two tiles exactly by exclusive-or and bit counts. A tile pair
returns a spanning forest of its links, never all pairs, so thousands of near copies stay linear."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import shuffle_partitions, slabs, staged, text_of, word_bounds
from quire.llm.components import components

SHINGLE = 4
RADIUS = 4
TILE = 2048
SEED = 42

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text: a bit is 1 if it is set in over half of the shingles' hashes."""
    ones = np.zeros((len(texts), 64), np.int64)
    total = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for buf, offsets, owners in slabs(texts, shingle - 1):
        low = _LOWER[buf]
        starts, ends = word_bounds(low)
        if not len(starts):
            continue
        seg = np.searchsorted(offsets, starts, side="right") - 1
        lengths = ends - starts
        # one space between words: every shingle is then one slice of this buffer
        at = np.cumsum(lengths + 1) - (lengths + 1)
        keep = np.repeat(starts - at, lengths + 1) + np.arange(at[-1] + lengths[-1] + 1)
        line = low[np.minimum(keep, len(low) - 1)]
        line[at + lengths] = 32
        line = line.tobytes()
        per_seg = np.bincount(seg, minlength=len(owners))
        last = np.arange(len(starts)) + shingle - 1
        whole = last < len(starts)
        whole[whole] = seg[last[whole]] == seg[:len(starts)][whole]
        first = np.flatnonzero(whole)
        final = last[first]
        short = np.flatnonzero((per_seg > 0) & (per_seg < shingle)) if shingle > 1 else np.empty(0, np.int64)
        # the whole text is short: its last segment still holds its first word
        short = np.array([s for s in short if owners[s][1] == 0 and owners[s][2]], np.int64)
        if len(short):
            begin = np.searchsorted(seg, short)
            first = np.concatenate([first, begin])
            final = np.concatenate([final, begin + per_seg[short] - 1])
            order = np.argsort(first, kind="stable")
            first, final = first[order], final[order]
        if not len(first):
            continue
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in
                              zip(at[first].tolist(), (at[final] + lengths[final]).tolist())), np.uint64, len(first))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        owner = np.array([o[0] for o in owners])[seg[first]]
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(owner) != 0)))
        np.add.at(ones, owner[cuts], np.add.reduceat(bits, cuts, axis=0, dtype=np.int64))
        np.add.at(total, owner[cuts], np.diff(np.append(cuts, len(owner))))
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, version, fp): one row per document; ``fp`` the fingerprint as a signed long, ``version`` a hash of the text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fp = text_fingerprints(texts, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("version"), pa.array(fp)],
                                             names=["id", "version", "fp"])

    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_of(text)).alias("version"), text_of(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, version long, fp long")


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two tiles (or inside one, ``right`` None).

    Rows are compared in small blocks; a fingerprint that already shares a tree adds no link."""
    nodes = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for a in range(0, len(left), 256):
        # unsigned, as numpy counts the bits of a signed value's magnitude
        near = np.bitwise_count((left[a:a + 256, None] ^ other[None, :]).view(np.uint64)) <= radius
        rows, cols = np.nonzero(near)
        rows = rows + a
        if right is None:
            up = rows < cols
            rows, cols = rows[up], cols[up]
        for i, j in zip(rows.tolist(), cols.tolist()):
            x, y = find(i), find(j + shift)
            if x != y:
                parent[y] = x
                links.append((int(nodes[i]), int(nodes[j + shift])))
    return links


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` at most ``radius`` bits apart.

    Returns a spanning forest per tile pair: the connected components equal those of all links."""
    spark = prints.sparkSession
    high = F.bit_count(F.shiftrightunsigned("fp", 32))
    low = F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF))
    cells = prints.select("fp", high.alias("hi"), low.alias("lo"))
    # a crowded cell is dealt to several tiles; the number of tiles of a cell follows from its size
    sizes = cells.groupBy("hi", "lo").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    # at most 33 x 33 cells, whatever the input
    sizes = F.broadcast(sizes)
    dealt = cells.join(sizes, ["hi", "lo"]).select(
        "hi", "lo", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("part"), "fp")
    tiles = staged(dealt.groupBy("hi", "lo", "part").agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    steps = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)
             if abs(i) + abs(j) <= radius and (i, j) >= (0, 0)]
    partner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    ahead = tiles.select("hi", "lo", "part", partner.alias("step")).select(
        "hi", "lo", "part", (F.col("hi") + F.col("step.i")).alias("hi2"), (F.col("lo") + F.col("step.j")).alias("lo2"))
    names = tiles.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("part").alias("part2"))
    pairs = ahead.join(names, ["hi2", "lo2"]).where(
        (F.col("hi") != F.col("hi2")) | (F.col("lo") != F.col("lo2")) | (F.col("part") <= F.col("part2")))
    left = tiles.select("hi", "lo", "part", F.col("fps").alias("left"))
    right = tiles.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("part").alias("part2"),
                         F.col("fps").alias("right"))
    same = (F.col("hi") == F.col("hi2")) & (F.col("lo") == F.col("lo2")) & (F.col("part") == F.col("part2"))
    work = pairs.join(left, ["hi", "lo", "part"]).join(right, ["hi2", "lo2", "part2"]).select(
        "left", F.when(~same, F.col("right")).alias("right"))
    work = work.repartition(4 * shuffle_partitions(spark), F.xxhash64("left", "right"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("left"), batch.column("right")):
                one = a.values.to_numpy(zero_copy_only=False)
                two = b.values.to_numpy(zero_copy_only=False) if b.is_valid else None
                found = _forest(one, two, radius)
                if found:
                    yield pa.RecordBatch.from_pydict({"a": [x for x, _ in found], "b": [y for _, y in found]},
                                                     schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return work.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, version, fp, group, component): one row per row of ``docs``.

    ``group`` names the connected group (its smallest fingerprint), ``component`` is the smallest id in it.
    Null and empty texts have fingerprint 0 and link like any other. Repeated rows share a group. A null
    id never is the smallest; ``component`` is null only where the whole group has null ids. Empty table: no rows."""
    prints = staged(fingerprints(docs, id_column, text, shingle), "simhash")
    classes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(prints.select("fp").distinct(), radius))
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .withColumn("group", F.coalesce("root", "fp"))
    least = named.groupBy("group").agg(F.min("least").alias("component"))
    member = named.select("fp", "group").join(least, "group")
    return prints.join(member, "fp")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``docs``: the one with the smallest id.

    Null ids come last, rows that share an id by a hash of their text; of fully repeated rows one stays."""
    near = near_duplicates(docs, id_column, text, shingle, radius)
    first = near.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "version")).alias("m"))

    def key(a: Column, version: Column) -> Column:
        return F.concat_ws("|", F.coalesce(a.cast("string"), F.lit("")), version.cast("string"))

    kept = first.select(key(F.col("m.id"), F.col("m.version")).alias("_key"))
    mine = docs.withColumn("_key", key(F.col(id_column), F.xxhash64(text_of(text))))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return mine.join(kept, "_key", "left_semi").withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)


def hex_fingerprint(column: str = "fp") -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
