"""Spans of regular-expression matches in whole texts, with DataFrame functions only.

A span is a struct (start, rank, end, kind, value): code-point offsets, end exclusive; ``rank`` orders kinds that start
together. Patterns avoid repeated groups that recurse and scans that restart inside a run, so long runs cost linear time.
Running sums and maxima over the spans of a text go part by part (``prefix``), as appending to one array copies it each time."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


@dataclass
class Kind:
    """A kind of span: a pattern, and a test on the match (a Column of the matched text) that it must pass."""

    name: str
    pattern: str
    keep: object = field(default=None)


PART = 256  # items of an array handled at once


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def parts(items: Column) -> Column:
    """An array cut into arrays of ``PART`` items."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(PART))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.slice(items, at, F.lit(PART)))


def prefix(numbers: Column, join, zero: int) -> Column:
    """What ``join`` makes of all numbers before each place (``zero`` before the first)."""
    kind = "array<int>"
    start = lambda at: F.struct(at.cast("int").alias("at"), F.array().cast(kind).alias("found"))
    step = lambda st, x: F.struct(join(st["at"], x).cast("int").alias("at"), F.array_append(st["found"], st["at"]).alias("found"))

    def whole(cut: Column) -> Column:
        totals = F.transform(cut, lambda c: F.aggregate(c, F.lit(zero), lambda acc, x: join(acc, x).cast("int")))
        before = F.aggregate(totals, start(F.lit(zero)), step, lambda st: st["found"])
        return F.flatten(F.zip_with(cut, before, lambda c, b: F.aggregate(c, start(b), step, lambda st: st["found"])))

    return let(parts(numbers), whole)


def running_max(numbers: Column) -> Column:
    """The greatest number before each place; -1 before the first."""
    return prefix(numbers, F.greatest, -1)


def _located(gaps: Column, values: Column, kind: Kind, rank: int) -> Column:
    """Spans from the text between the matches and the matches: offsets are running sums of their lengths."""
    empty = F.array().cast(f"array<{SPAN}>")

    def spans(of_gap: Column, found: Column) -> Column:
        sizes = F.zip_with(of_gap, found, lambda g, v: g + F.char_length(v))

        def span(v: Column, i: Column, before: Column) -> Column:
            begin = F.get(before, i) + F.get(of_gap, i)
            return F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + F.char_length(v)).alias("end"),
                            F.lit(kind.name).alias("kind"), v.alias("value"))

        return let(prefix(sizes, lambda a, b: a + b, 0), lambda before: F.transform(found, lambda v, i: span(v, i, before)))

    def kept(found: Column) -> Column:
        of_gap = F.transform(F.slice(gaps, F.lit(1), F.size(found)), F.char_length)
        out = let(of_gap, lambda g: spans(g, found))
        return out if kind.keep is None else F.filter(out, lambda s: F.coalesce(kind.keep(s["value"]), F.lit(False)))

    return F.when(F.size(values) == 0, empty).otherwise(let(values, kept))


def uncovered(new: Column, held: Column) -> Column:
    """The spans of ``new`` (sorted) that no span of ``held`` (sorted) contains."""
    marked = lambda spans, mark: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(mark).alias("new"), s["end"].alias("end"), s.alias("span")))

    def sieve(both: Column) -> Column:
        reach = running_max(F.transform(both, lambda x: F.when(x["new"] == 0, x["end"]).otherwise(F.lit(-1))))
        return let(reach, lambda r: F.filter(F.transform(both, lambda x, i: F.when(
            (x["new"] == 1) & (F.get(r, i) < x["end"]), x["span"])), lambda s: s.isNotNull()))

    return F.when((F.size(new) == 0) | (F.size(held) == 0), new).otherwise(
        let(F.array_sort(F.concat(marked(held, 0), marked(new, 1))), sieve))


def untouched(new: Column, held: Column) -> Column:
    """The spans of ``new`` (sorted) that share no character with a span of ``held`` (sorted)."""
    marked = lambda spans, mark: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(mark).alias("new"), s["end"].alias("end"), s.alias("span")))
    far = (1 << 31) - 1

    def sieve(both: Column) -> Column:
        reach = running_max(F.transform(both, lambda x: F.when(x["new"] == 0, x["end"]).otherwise(F.lit(-1))))
        # the next held span: the least start after each place, from the end backwards
        after = F.reverse(prefix(F.reverse(F.transform(both, lambda x: F.when(x["new"] == 0, x["start"]).otherwise(F.lit(far)))), F.least, far))
        return let(reach, lambda r: let(after, lambda a: F.filter(F.transform(both, lambda x, i: F.when(
            (x["new"] == 1) & (F.get(r, i) <= x["start"]) & (F.get(a, i) >= x["end"]), x["span"])), lambda s: s.isNotNull())))

    return F.when((F.size(new) == 0) | (F.size(held) == 0), new).otherwise(
        let(F.array_sort(F.concat(marked(held, 0), marked(new, 1))), sieve))


def find(df: DataFrame, kinds: list[Kind], text: str, out: str) -> DataFrame:
    """Add ``out``: all spans of ``kinds`` in the column ``text`` (not null), sorted by start, then kind as listed.

    Matches are leftmost and do not overlap within a kind; those that fail their kind's test are dropped."""
    cols = df.columns
    parts = [c for i, k in enumerate(kinds) for c in (
        F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias(f"_v{i}"),
        F.split(text, k.pattern, -1).alias(f"_g{i}"))]
    found = [_located(F.col(f"_g{i}"), F.col(f"_v{i}"), k, i) for i, k in enumerate(kinds)]
    return df.select(*cols, *parts).select(*cols, F.array_sort(F.concat(*found)).alias(out))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, label) -> Column:
    """The text with every span replaced by ``label(span)``; what overlaps goes with the first.

    The text is cut before every ``PART``-th span, so a span's surroundings are looked up in a short piece."""
    def whole(sorted_spans: Column) -> Column:
        return let(running_max(F.transform(sorted_spans, lambda s: s["end"])), lambda reach: let(parts(F.filter(F.transform(
            sorted_spans, lambda s, i: F.when(s["start"] >= F.get(reach, i), F.struct(
                s["start"].alias("start"), F.get(reach, i).alias("from"), s.alias("span")))), lambda x: x.isNotNull())), pieces))

    def pieces(groups: Column) -> Column:
        def piece(group: Column) -> Column:
            begin, last = F.greatest(F.get(group, 0)["from"], F.lit(0)), F.element_at(group, -1)["start"]
            near = F.substr(text, begin + 1, last - begin)
            return let(near, lambda part: F.array_join(F.transform(group, lambda x: F.concat(
                F.substr(part, F.greatest(x["from"], F.lit(0)) - begin + 1, x["start"] - F.greatest(x["from"], F.lit(0))),
                label(x["span"]))), ""))
        return F.array_join(F.transform(groups, piece), "")

    end = F.aggregate(spans, F.lit(0), lambda acc, s: F.greatest(acc, s["end"]))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(let(F.array_sort(spans), whole), F.substr(text, end + 1, F.char_length(text))))
