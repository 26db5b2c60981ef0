"""Secret scans with DataFrame functions: fixed patterns, and sliding-window entropy over candidate strings.

Base spans come from three patterns. Beside them, every run of token characters is a candidate; a window slides over
it with the counts of its characters as state, and its Shannon entropy changes with the two counts that change per step. Each
window is of the class of its own characters, and each class has its own threshold. A window on the allow list is suppressed;
the other hits of a class that overlap or touch make a span. Base spans always stay."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import spans as S
from quire.llm.common import text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    S.Kind("assign", ASSIGN, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
    S.Kind("access", r"AKIA[A-Z0-9]{14,}"),  # runs of under 18 in all never match, from any start
    S.Kind("hex", r"[0-9a-f]{16,}"),
]
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"  # of candidates, hexadecimal digits first
HEX_DIGITS = 22
#: entropy in bits that a window must reach, per character class (20 characters reach at most 4.32); hexadecimal digits alone, or any
CLASSES = {"entropy_hex": 3.0, "entropy_base64": 4.0}
#: windows that look random but are not secret
ALLOW = [
    r"^[0-9A-Fa-f]*(?:-[0-9A-Fa-f]{4}){2,3}-?[0-9A-Fa-f]*$",  # within identifiers
    r"^[^A-Za-z]+$", r"^[^0-9]+$",  # numbers; words
    r"(?i)example|sample|dummy|placeholder|xxxx|changeme",
    r"(?i)0123456789|abcdefghij|qwertyuiop",
    r"^[A-Za-z]*(?:[-_/=+]+[A-Za-z]+|[-_/=+]+[0-9]{1,4})+[-_/=+]*$",  # words and short numbers, joined
]
BLOCK = 2048  # characters of a long candidate handled by one array
UNIT = 1 << 20  # entropies are compared in whole units, so they are the same on every engine
_RUN = "struct<hex:boolean,first:int,last:int>"


def unit_terms(window: int = WINDOW) -> list[int]:
    """c * log2(c) in whole units, for counts c up to the window."""
    return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(window + 1)]


def unit_limit(bits: float, window: int = WINDOW) -> int:
    """The sum of ``unit_terms`` at which a window's entropy is ``bits``: log2(window) less that sum over the window."""
    return int(window * (math.log2(window) - bits) * UNIT)


def _hits(part: Column, window: int, allowed: str) -> Column:
    """Runs (hex, first, last) of windows that hit, by the window's last character, from 1; windows of one run overlap or touch."""
    codes = F.transform(F.split(F.substr(part, F.lit(1), F.char_length(part)), ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    terms = F.array(*[F.lit(t) for t in unit_terms(window)])
    term = lambda n: F.get(terms, n)
    limit_hex, limit_any = unit_limit(CLASSES["entropy_hex"], window), unit_limit(CLASSES["entropy_base64"], window)
    zero = F.lit(0)
    none = F.array().cast(f"array<{_RUN}>")
    state = F.struct(zero.alias("i"), zero.alias("s"), zero.alias("wide"), F.array_repeat(zero, len(ALPHABET)).alias("counts"),
                     F.lit(None).cast(_RUN).alias("run"), none.alias("runs"))

    def slid(chars: Column) -> Column:
        def step(st: Column, code: Column) -> Column:
            i = st["i"] + 1
            full = i > window
            gone = F.when(full, F.get(chars, i - window - 1)).otherwise(-1)
            c = F.get(st["counts"], code)
            # the count that falls is read after the one that rises
            d = F.when(full, F.get(st["counts"], gone) + F.when(gone == code, 1).otherwise(0))
            s = st["s"] + term(c + 1) - term(c) + F.when(full, term(d - 1) - term(d)).otherwise(0)
            wide = st["wide"] + F.when(code >= HEX_DIGITS, 1).otherwise(0) - F.when(gone >= HEX_DIGITS, 1).otherwise(0)
            counts = F.transform(st["counts"], lambda n, j: n + F.when(j == code, 1).otherwise(0) - F.when(j == gone, 1).otherwise(0))
            return let_state(st, i, s, wide, counts)

        def let_state(st: Column, i: Column, s: Column, wide: Column, counts: Column) -> Column:
            def moved(x: Column) -> Column:
                hexed = x["wide"] == 0
                high = (x["i"] >= window) & (x["s"] <= F.when(hexed, limit_hex).otherwise(limit_any))
                hit = high & (~F.substr(part, x["i"] - window + 1, F.lit(window)).rlike(allowed) if allowed else F.lit(True))
                run = st["run"]
                goes_on = run.isNotNull() & (run["hex"] == hexed) & (x["i"] - window <= run["last"])
                after = F.when(hit, F.struct(hexed.alias("hex"), F.when(goes_on, run["first"]).otherwise(x["i"]).alias("first"),
                                             x["i"].alias("last"))).otherwise(run)
                runs = F.when(hit & run.isNotNull() & ~goes_on, F.array_append(st["runs"], run)).otherwise(st["runs"])
                return F.struct(x["i"].alias("i"), x["s"].alias("s"), x["wide"].alias("wide"), x["counts"].alias("counts"),
                                after.alias("run"), runs.alias("runs"))

            return S.let(F.struct(i.alias("i"), s.alias("s"), wide.alias("wide"), counts.alias("counts")), moved)

        return F.aggregate(chars, state, step, lambda st: F.when(st["run"].isNotNull(), F.array_append(st["runs"], st["run"]))
                           .otherwise(st["runs"]))

    return S.let(F.slice(codes, F.lit(1), F.char_length(part)), slid)


def _joined_runs(runs: Column, window: int) -> Column:
    """Runs of consecutive blocks, those that overlap or touch made one."""
    none = F.array().cast(f"array<{_RUN}>")
    state = F.struct(F.lit(None).cast(_RUN).alias("run"), none.alias("out"))

    def step(st: Column, x: Column) -> Column:
        run = st["run"]
        goes_on = run.isNotNull() & (run["hex"] == x["hex"]) & (x["first"] - window <= run["last"])
        return F.struct(F.when(goes_on, F.struct(x["hex"].alias("hex"), run["first"].alias("first"), x["last"].alias("last")))
                        .otherwise(x).alias("run"),
                        F.when(run.isNotNull() & ~goes_on, F.array_append(st["out"], run)).otherwise(st["out"]).alias("out"))

    return F.aggregate(runs, state, step, lambda st: F.when(st["run"].isNotNull(), F.array_append(st["out"], st["run"])).otherwise(st["out"]))


def entropy_spans(df: DataFrame, text: str, out: str, window: int = WINDOW, allow: list[str] | None = None) -> DataFrame:
    """Add ``out``: a span per run of windows of high entropy in a candidate, from the start of the first window to the end of
    the last, sorted by start, then kind."""
    cols = df.columns
    allowed = "|".join(f"(?:{p})" for p in (ALLOW if allow is None else allow))
    found = S.find(df, [S.Kind("candidate", CANDIDATE)], text, "_cand")
    (first, _), (second, _) = CLASSES.items()

    def runs(value: Column) -> Column:
        def block(at: Column) -> Column:
            mine = S.let(F.substr(value, at, F.lit(BLOCK + window - 1)), lambda part: _hits(part, window, allowed))
            return F.transform(mine, lambda r: F.struct(r["hex"].alias("hex"), (r["first"] + at - 1).alias("first"), (r["last"] + at - 1).alias("last")))

        starts = F.sequence(F.lit(1), F.char_length(value) - window + 1, F.lit(BLOCK))
        return _joined_runs(F.flatten(F.transform(starts, block)), window)

    def spans(s: Column) -> Column:
        return F.transform(runs(s["value"]), lambda r: F.struct(
            (s["start"] + r["first"] - window).alias("start"), F.when(r["hex"], len(BASE)).otherwise(len(BASE) + 1).alias("rank"),
            (s["start"] + r["last"]).alias("end"), F.when(r["hex"], first).otherwise(second).alias("kind"),
            F.substr(s["value"], r["first"] - window + 1, r["last"] - r["first"] + window).alias("value")))

    return found.select(*cols, F.array_sort(F.flatten(F.transform("_cand", spans))).alias(out))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", carry: list[str] = ()) -> DataFrame:
    """(id, text, base, spans) and the columns ``carry`` of every row: ``base`` are the pattern spans, ``spans`` these and
    the entropy spans that no base span covers, sorted by start, then kind.

    Null texts are empty: no spans. Rows are independent, so ids may be null or repeat. Empty table: no rows."""
    rows = docs.select(F.col(id_column).alias("id"), text_of(text).alias("text"), *carry)
    rows = entropy_spans(S.find(rows, BASE, "text", "base"), "text", "_more")
    new = S.uncovered(F.col("_more"), F.col("base"))
    return rows.select("id", "text", *carry, "base", F.array_sort(F.concat("base", new)).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by ``[SECRET]``."""
    return S.redact(text, spans, lambda s: F.lit("[SECRET]"))
