"""Column expressions (all built-in, codegen friendly, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

# The text normal form keeps lower-case ASCII letters and
# ASCII white space; tokens are the runs between white space.
KEEP_PATTERN = r"[^a-z \t\n\r\f\x0B]"
SPLIT_PATTERN = r"[ \t\n\r\f\x0B]+"
LIST_PUNCT_PATTERN = r"[\[\]']"

# Unix seconds of the first and last second of the years 1 to 9999.
_SECONDS = (-62135596800, 253402300799)
# White space beyond ASCII that separates words.
_SPACES = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unix_to_timestamp(seconds, zone: str = "UTC") -> Column:
    """Unix seconds -> local wall time (TIMESTAMP_NTZ) in ``zone``.

    Computed without the session zone, so the result does not depend on
    where the driver runs. Seconds outside the years 1 to 9999 give null.
    """
    s = _col(seconds).cast("bigint")
    s = F.when(s.between(*_SECONDS), s)
    utc = F.expr(_EPOCH) + F.make_dt_interval(days=F.floor(s / 86400).cast("int"),
                                               secs=F.pmod(s, F.lit(86400)).cast("decimal(18,6)"))
    if zone.upper() in ("UTC", "Z", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def unix_to_text(seconds, zone: str = "UTC", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Unix seconds -> text time in ``zone`` (the form ``from_unixtime`` prints)."""
    return F.date_format(unix_to_timestamp(seconds, zone), fmt)


def text_to_year(text) -> Column:
    """'yyyy-MM-dd ...' -> year as int; unparsable -> null."""
    return F.year(F.try_to_timestamp(F.substring(_col(text), 1, 10), F.lit("yyyy-MM-dd"))).cast("int")


def word_count(text) -> Column:
    """Pieces between single spaces: empty pieces count, '' -> 1, null -> null."""
    return F.size(F.split(_col(text), " ")).cast("int")


def strip_list(text) -> Column:
    """"['A', 'B']" -> "A, B": drop brackets and single quotes."""
    return F.regexp_replace(_col(text), LIST_PUNCT_PATTERN, "")


def normalize_text(text) -> Column:
    """Lower case, other white space to blanks, then delete everything but a-z and white space."""
    return F.regexp_replace(F.translate(F.lower(_col(text)), _SPACES, " " * len(_SPACES)), KEEP_PATTERN, "")


def tokens(text, normalize: bool = True) -> Column:
    """Array of white-space separated words (no empty strings)."""
    t = normalize_text(text) if normalize else _col(text)
    return F.array_remove(F.split(t, SPLIT_PATTERN), "")


def year_to_date(year) -> Column:
    """Year number -> first of January; not a number or out of range -> null."""
    y = _col(year).try_cast("int")
    return F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))


def safe_cast(c, to: str | DataType) -> Column:
    """Cast that turns unparsable input into null instead of failing (ANSI mode)."""
    return _col(c).try_cast(to)


def is_missing(name: str, dtype: DataType) -> Column:
    """Null, or NaN for floating columns (``isnan`` is only legal there)."""
    c = F.col(name)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
