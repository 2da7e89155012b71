"""Date parsing and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from ..specs import NULL_DATE_TOKENS

# The text forms a date may arrive in (compact, dash, slash).
# 'M' and 'd' take one or two digits, so 2025-1-3 parses like 2025-01-03.
COMPACT, DASH, SLASH = "yyyyMMdd", "yyyy-M-d", "yyyy/M/d"

#: Whitespace of a pattern's ``\\s``, and what its ``$`` stands before.
_EDGES = " \t\n\x0b\f\r\x85\u2028\u2029"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim all leading / trailing whitespace (``trim`` only removes spaces).
    Text without any is taken as it is, at the cost of a comparison."""
    text = _col(c).cast("string")
    return F.when(F.trim(text, F.lit(_EDGES)) == text, text).otherwise(F.regexp_replace(text, r"^\s+|\s+$", ""))


def parse_date_multi(c, dtype: T.DataType | None = None) -> Column:
    """Lenient date parse of a raw value.

    Text is trimmed; the tokens '', 'None', 'null', 'NULL' mean null; the
    first of yyyyMMdd, yyyy-M-d, yyyy/M/d that parses wins; anything else
    (e.g. 20250230) is null.  Values already typed as date pass through and
    timestamps keep their date part.
    """
    if isinstance(dtype, T.DateType):
        return _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(_col(c))
    text = strip_ws(c)
    # a text fits one form at most; the separator tells which to try, as a
    # parse that fails costs many times one that succeeds
    parsed = F.coalesce(
        F.when(F.contains(text, F.lit("-")), F.try_to_date(text, DASH)),
        F.when(F.contains(text, F.lit("/")), F.try_to_date(text, SLASH)),
        F.try_to_date(text, COMPACT),
    )
    return F.when(text.isin(*NULL_DATE_TOKENS), F.lit(None).cast("date")).otherwise(parsed)


def parse_date_two(c) -> Column:
    """Calendar / raw-layer parse: yyyyMMdd, else yyyy-M-d, untrimmed."""
    text = _col(c).cast("string")
    return F.coalesce(F.when(F.contains(text, F.lit("-")), F.try_to_date(text, DASH)), F.try_to_date(text, COMPACT))


def date_text(c) -> Column:
    """Date as yyyyMMdd text."""
    return F.date_format(_col(c), COMPACT)


def iso_text(c) -> Column:
    """Date as ISO yyyy-MM-dd text."""
    return _col(c).cast("date").cast("string")


def date_windows(start, end, days: int) -> Column:
    """Array of (window_start, window_end) structs splitting [start, end] into
    closed windows of ``days`` days; the last window is cut at ``end``."""
    if days <= 0:
        raise ValueError("window length must be positive")
    s, e = _col(start), _col(end)
    starts = F.sequence(s, e, F.expr(f"INTERVAL {int(days)} DAYS"))
    return F.transform(
        starts,
        lambda ws: F.struct(ws.alias("window_start"),
                            F.least(F.date_add(ws, days - 1), e).alias("window_end")),
    )


def year_span(start, end) -> Column:
    """Years touched by a date range; reversed bounds are swapped."""
    s, e = _col(start), _col(end)
    return F.sequence(F.year(F.least(s, e)), F.year(F.greatest(s, e)))
