"""Removal of repeated passages: every window of 20 words that also starts earlier in the corpus.

Documents are dealt into blocks of some megabytes, compressed and written once. Rabin-Karp hashes of all windows are computed in
numpy over whole texts, and each window has an anchor: the smallest hash among the short word runs inside it. Equal windows have
equal anchors at equal offsets. A first count (``tally``) takes the anchors alone, a seventh of the windows and a few bytes each; a
window whose anchor occurs once in the corpus cannot repeat and goes no further. The others travel grouped by anchor, in one
compact row per run of windows, and meet all their copies; each block settles its own repeats before, so only the first
copy of a block travels. The windows of an anchor with very many occurrences travel one by one instead, keyed by their own hash, and
meet in two rounds: a block hash spreads them first, so no task gets all copies of a common passage. Two windows are equal if
two independent hashes are. Sorted rows are read as a stream; every window after the first of its kind becomes a removal
interval, and the intervals of a document merge when its words are cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import tally
from quire.llm.common import (mix, other_word_hashes, rolling, shuffle_partitions, slabs, staged, text_of, word_bounds,
                              word_hashes)

WINDOW = 20
ANCHOR = 8
HASH_BYTES = 12  # of a window: 8 and 4 of two independent hashes, beside the 8 of its anchor and its offset from it
HOT_ROWS = 1 << 14  # occurrences of one anchor; beyond, its windows are dealt one by one, which changes no result
SPREAD = 64  # parts of the copies of such a window in the first round
BLOCK_BYTES = 4 << 20  # text whose repeats are settled before the shuffle
ANCHOR_BYTES = 40  # of text per distinct anchor, roughly: sizes the hash ranges
NO_ID = -(1 << 63)

_FIELDS = [("anchor", pa.int64()), ("doc", pa.int64()), ("version", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()),
           ("block", pa.int64()), ("hot", pa.bool_()), ("windows", pa.binary())]
_ROWS = pa.schema(_FIELDS)
_DDL = "anchor long, doc long, version int, start long, stop long, block long, hot boolean, windows binary"


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Row identity: the id (null before all others) and a hash of the text for rows that share an id."""
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.col(id_column).alias("id"), text_of(text).alias("text")) \
        .withColumn("version", F.pmod(F.xxhash64("text"), F.lit(2147483647)).cast("int"))


def _windows(texts: list[bytes], window: int, anchor: int):
    """Arrays over all windows: text index, first word, hash, second hash, anchor hash, anchor offset."""
    span = window - anchor + 1
    found = []
    for buf, offsets, owners in slabs(texts, window - 1):
        starts, ends = word_bounds(buf)
        n = len(starts)
        if n < window:
            continue
        words = word_hashes(buf, starts, ends)
        seg = np.searchsorted(offsets, starts, side="right") - 1
        first = np.arange(n - window + 1)
        whole = rolling(words, first, first + window)
        other = (rolling(other_word_hashes(buf, starts, ends), first, first + window) >> np.uint64(32)).astype(np.uint32)
        run = np.arange(n - anchor + 1)
        short = rolling(words, run, run + anchor)
        at = np.lib.stride_tricks.sliding_window_view(short, span).argmin(axis=1)
        inside = seg[first] == seg[first + window - 1]
        first = first[inside]
        own = seg[first]
        begin = np.searchsorted(seg, np.arange(len(owners)))
        base = np.array([o[1] for o in owners]) - begin
        found.append((np.array([o[0] for o in owners])[own], first + base[own], whole[first], other[first],
                      short[first + at[first]], at[first]))
    if not found:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)) + (np.empty(0, np.int64),)
    return tuple(np.concatenate(x) for x in zip(*found))


def _combine(docs: np.ndarray, versions: np.ndarray, texts: list[bytes], window: int, anchor: int, block: int = 0,
             answers: tally.Answers | None = None) -> pa.RecordBatch:
    """Rows for the shuffle out of a block, in order of (doc, version): the windows' first copies by anchor (one by
    one for hot anchors, keyed by the window's hash), and the intervals of the repeats in this block (``stop``
    over 0). ``answers`` says which anchors repeat at all and which are hot."""
    text, start, whole, other, anchors, offset = _windows(texts, window, anchor)
    alone = np.zeros(len(start), bool)
    if answers is not None:
        held = answers.holds(anchors, "often")
        text, start, whole, other, anchors, offset = (x[held] for x in (text, start, whole, other, anchors, offset))
        alone = answers.holds(anchors, "heavy")
    # texts come sorted, windows in order, so a stable sort by hashes keeps the earliest copy first
    order = np.lexsort((other, whole))
    same = (whole[order][1:] == whole[order][:-1]) & (other[order][1:] == other[order][:-1])
    head = np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else np.empty(0, np.int64)
    lead = np.repeat(order[head], np.diff(np.append(head, len(order))))
    # a repeated row of the table is the same document, not an earlier one
    twin = (docs[text[order]] == docs[text[lead]]) & (versions[text[order]] == versions[text[lead]]) \
        & (start[order] == start[lead])
    repeat = np.zeros(len(order), bool)
    repeat[order] = (order != lead) & ~twin
    later = np.zeros(len(order), bool)
    later[order] = order != lead
    kept, gone = np.flatnonzero(~later), np.flatnonzero(repeat)
    key = np.where(alone, mix(anchors * np.uint64(3) + whole), anchors)

    def runs(rows: np.ndarray, *same: np.ndarray) -> np.ndarray:
        change = np.ones(len(rows), bool)
        if len(rows):
            change[1:] = (np.diff(start[rows]) != 1) | (np.diff(text[rows]) != 0)
            for values in same:
                change[1:] |= np.diff(values[rows]) != 0
        return np.flatnonzero(change)

    # one by one: a place of its own for every window of a hot anchor
    a = runs(kept, np.where(alone, -2 * start - 2, start + offset))
    size = np.diff(np.append(a, len(kept)))
    data = np.zeros(len(a) + len(kept) * HASH_BYTES, np.uint8)
    ends = np.cumsum(1 + size * HASH_BYTES)
    begins = ends - (1 + size * HASH_BYTES)
    data[begins] = offset[kept[a]]
    body = np.ones(len(data), bool)
    body[begins] = False
    hashes = np.concatenate([whole[kept].astype("<u8").view(np.uint8).reshape(-1, 8),
                             other[kept].astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)
    data[body] = hashes.reshape(-1)
    b = runs(gone)
    tail = gone[np.append(b[1:], len(gone)) - 1] if len(gone) else gone
    rows = np.concatenate([kept[a], gone[b]])
    stop = np.concatenate([np.zeros(len(a), np.int64), start[tail] + window])
    # finished intervals travel with the rest, spread by a hash of their place
    key = np.concatenate([key[kept[a]], whole[gone[b]]]).view(np.int64)
    hot = np.concatenate([alone[kept[a]], np.zeros(len(b), bool)])
    blobs = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.concatenate(
        [[0], ends, np.full(len(b), ends[-1] if len(ends) else 0)]).astype(np.int32)), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs[text[rows]]), pa.array(versions[text[rows]]),
                                       pa.array(start[rows].astype(np.int64)), pa.array(stop.astype(np.int64)),
                                       pa.array(np.full(len(rows), block), pa.int64()), pa.array(hot), blobs], schema=_ROWS)


def _settle(window: int, rounds: bool = False):
    """Stream over rows sorted by (anchor, doc, version, start): windows seen before become intervals (``stop`` over 0).

    Between batches only the first copies of the last anchor are kept. With ``rounds`` the first copies of hot windows are handed on
    as rows for another round."""
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # of the last anchor: anchor, and arrays key, second key, doc, version, start
        for batch in batches:
            if not batch.num_rows:
                continue
            stop = batch.column("stop").to_numpy()
            if (stop > 0).any():
                yield batch.filter(pa.array(stop > 0))
                batch = batch.filter(pa.array(stop == 0))
                if not batch.num_rows:
                    continue
            blob = batch.column("windows")
            ends = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset:blob.offset + len(blob) + 1]
            data = np.frombuffer(blob.buffers()[2], np.uint8)[ends[0]:ends[-1]]
            begins = ends[:-1] - ends[0]
            size = (np.diff(ends) - 1) // HASH_BYTES
            body = np.ones(len(data), bool)
            body[begins] = False
            wide = data[body].reshape(-1, HASH_BYTES)
            row = np.repeat(np.arange(len(size)), size)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            # the window's hash; its second hash and the offset of the anchor in it
            offset = data[begins][row].astype(np.int64) - nth
            key = np.ascontiguousarray(wide[:, :8]).view("<u8").reshape(-1)
            second = np.ascontiguousarray(wide[:, 8:]).view("<u4").reshape(-1) | (offset.astype(np.uint64) << np.uint64(32))
            anchors = batch.column("anchor").to_numpy()[row]
            docs = batch.column("doc").to_numpy()[row]
            versions = batch.column("version").to_numpy()[row]
            start = batch.column("start").to_numpy()[row] + nth
            old = 0
            if held is not None and held[0] == anchors[0]:
                old = len(held[1])
                key, second = np.concatenate([held[1], key]), np.concatenate([held[2], second])
                docs, versions = np.concatenate([held[3], docs]), np.concatenate([held[4], versions])
                start = np.concatenate([held[5], start])
                anchors = np.concatenate([np.full(old, held[0]), anchors])
            order = np.lexsort((np.arange(len(key)), second, key, anchors))
            same = (key[order][1:] == key[order][:-1]) & (second[order][1:] == second[order][:-1]) & (anchors[order][1:] == anchors[order][:-1])
            head = np.flatnonzero(np.concatenate(([True], ~same)))
            lead = np.repeat(order[head], np.diff(np.append(head, len(order))))
            twin = (docs[order] == docs[lead]) & (versions[order] == versions[lead]) & (start[order] == start[lead])
            repeat = np.zeros(len(order), bool)
            repeat[order] = (order != lead) & ~twin
            first = np.zeros(len(order), bool)
            first[order] = twin
            firsts = np.sort(order[head])
            firsts = firsts[anchors[firsts] == anchors[-1]]
            held = (anchors[-1], key[firsts], second[firsts], docs[firsts], versions[firsts], start[firsts])
            if rounds:
                hot = batch.column("hot").to_numpy(zero_copy_only=False)
                on = np.unique(row[first[old:] & hot[row]])  # a hot row is one window
                if len(on):
                    yield batch.take(pa.array(on))
            gone = np.flatnonzero(repeat[old:])
            if not len(gone):
                continue
            docs, versions, start, row = docs[old:], versions[old:], start[old:], row
            blocks = batch.column("block").to_numpy()[row]
            change = np.ones(len(gone), bool)
            change[1:] = (np.diff(start[gone]) != 1) | (np.diff(docs[gone]) != 0) | (np.diff(versions[gone]) != 0) \
                | (np.diff(blocks[gone]) != 0)
            a = np.flatnonzero(change)
            z = np.append(a[1:], len(gone)) - 1
            n = len(a)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int64)), pa.array(docs[gone[a]]), pa.array(versions[gone[a]]), pa.array(start[gone[a]]),
                pa.array(start[gone[z]] + window), pa.array(blocks[gone[a]]), pa.array(np.zeros(n, bool)),
                pa.array([b""] * n, pa.binary())], schema=_ROWS)
    return settle


# --- blocks of documents -------------------------------------------------------------------------

def blocks(docs: DataFrame, id_column: str, text: str, size: int = BLOCK_BYTES) -> DataFrame:
    """(block, bytes, body): documents in blocks of about ``size`` bytes of text, sorted by (doc, version), written once."""
    rows = _keyed(docs, id_column, text)
    def written(number: int, parts: list[pa.RecordBatch], held: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).sort_by([("doc", "ascending"), ("version", "ascending")])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "bytes": pa.array([held], pa.int64()),
                                           "body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0).to_numpy()
            at = 0
            for i, n in enumerate(lengths.tolist()):
                held += n + 32
                if held >= size:
                    yield written(number, [*parts, batch.slice(at, i + 1 - at)], held)
                    number, parts, held, at = number + 1, [], 0, i + 1
            if at < batch.num_rows:
                parts.append(batch.slice(at))
        if parts:
            yield written(number, parts, held)

    return staged(rows.mapInArrow(deal, "block long, bytes long, body binary"), "passage-blocks")


def _opened(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all().combine_chunks()


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return table["doc"].to_numpy(), table["version"].to_numpy(), table["text"].cast(pa.binary()).to_pylist()


def _anchor_rows(window: int, anchor: int, bits: int, cap: int):
    """Distinct anchors of each block with the number of places where they stand."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in tally.each(batches):
            text, start, _, _, anchors, offset = _windows(_columns(_opened(row["body"]))[2], window, anchor)
            place = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(start + offset) != 0))[:len(text)])
            found, n = np.unique(anchors[place], return_counts=True)
            if len(found):
                yield tally.packed(row["block"], found, n, bits, cap)
    return count


def _window_rows(window: int, anchor: int, bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in tally.each(batches):
            out = _combine(*_columns(_opened(row["body"])), window, anchor, row["block"], tally.Answers(row["answers"], bits))
            for at in range(0, out.num_rows, 50_000):
                yield out.slice(at, 50_000)
    return rows


def removal_intervals(dealt: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(block, doc, version, start, stop): word intervals of the documents of ``blocks`` covered by windows that also start
    earlier (not yet merged)."""
    spark = dealt.sparkSession
    n = shuffle_partitions(spark)
    bits = tally.range_bits((dealt.agg(F.sum("bytes")).first()[0] or 0) / ANCHOR_BYTES)
    cap = max(2, hot_rows + 1)
    answers = tally.frequent(dealt.mapInArrow(_anchor_rows(window, anchor, bits, cap), tally.ROWS), 2, cap, hot_rows)
    rows = dealt.join(answers, "block").select("block", "body", "answers").mapInArrow(_window_rows(window, anchor, bits), _DDL)
    order = ["anchor", "doc", "version", "start"]
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("block"), F.lit(SPREAD))).otherwise(F.lit(0))
    first = rows.withColumn("part", part).repartition(n, "anchor", "part").sortWithinPartitions(*order).drop("part")
    first = staged(first.mapInArrow(_settle(window, rounds=True), _DDL), "passage-intervals")
    again = first.where("hot").repartition(n, "anchor").sortWithinPartitions(*order).mapInArrow(_settle(window), _DDL)
    found = first.where("stop > 0").unionByName(again.where("stop > 0"))
    return found.select("block", "doc", "version", "start", "stop")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
                anchor: int = ANCHOR, hot_rows: int = HOT_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept): one row per row of ``docs``; ``kept`` is the remaining words joined by one space.

    Null and empty texts have no words. Texts shorter than the window lose nothing. Rows that share an id are
    ordered by a hash of their text; fully repeated rows are one document and do not count as each other's
    earlier copy. A null id comes before all others. Empty table: no rows."""
    dealt = blocks(docs, id_column, text, block_bytes)
    spans = removal_intervals(dealt, window, anchor, hot_rows).groupBy("block") \
        .agg(F.collect_list(F.struct("doc", "version", "start", "stop")).alias("spans"))
    joined = dealt.join(spans, "block", "left").select("body", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, found in zip(batch.column("body"), batch.column("spans")):
                table = _opened(body.as_py())
                docs, versions, texts = _columns(table)
                mine: dict[tuple, np.ndarray] = {}
                if found.is_valid:
                    d, v, a, z = (x.to_numpy() for x in found.values.flatten())
                    order = np.lexsort((v, d))
                    edge = np.flatnonzero(np.append(True, (np.diff(d[order]) != 0) | (np.diff(v[order]) != 0)))
                    for at, end in zip(edge, np.append(edge[1:], len(order))):
                        own = order[at:end]
                        mine[d[own[0]], v[own[0]]] = np.stack([a[own], z[own]])
                total, lost, kept = [], [], []
                for i, raw in enumerate(texts):
                    words = raw.split()
                    n = len(words)
                    both = mine.get((docs[i], versions[i]))
                    if both is not None:
                        gone = np.zeros(n + 1, np.int64)
                        np.add.at(gone, both[0], 1)
                        np.add.at(gone, both[1], -1)
                        gone = np.cumsum(gone)[:n] > 0
                        words = [words[w] for w in np.flatnonzero(~gone).tolist()]
                    total.append(n)
                    lost.append(n - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([table["id"].combine_chunks(), pa.array(total, pa.int64()),
                                                  pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                                 names=["id", "n_words", "n_removed", "kept"])

    kind = docs.schema[id_column].dataType.simpleString()
    return joined.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, kept string")
