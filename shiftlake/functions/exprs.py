"""Column expressions, all built from JVM-side Spark functions (no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlake.functions.dates import in_utc
from shiftlake.params import NA_TOKENS, PY_WHITESPACE_CLASS, TS_MAX, TS_MIN

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 86_400_000_000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: Column | str, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Missing-value tokens (matched on the untrimmed text) become null."""
    c = _c(c)
    longest = max(len(t.encode()) for t in tokens)
    return F.when((F.octet_length(c) <= longest) & c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def strip_all(c: Column | str) -> Column:
    """Remove leading and trailing whitespace as Python's ``str.strip`` does.

    Spark's ``trim`` removes spaces only; this class also covers tabs, line
    breaks, separators and the Unicode blanks. The regex runs only on cells
    whose first or last character lies outside "!" to U+007F, as all of them do
    (strings compare by their UTF-8 bytes), so clean cells cost a few comparisons.
    """
    c = _c(c)
    ws = PY_WHITESPACE_CLASS
    outside = lambda x: (x < F.lit("!")) | (x >= F.lit("\u0080"))
    edge = outside(c) | outside(F.substring(c, -1, 1))
    return F.when(edge, F.regexp_replace(c, f"\\A{ws}+|{ws}+\\z", "")).otherwise(c)


def round_half_away(c: Column | str, digits: int) -> Column:
    """ROUND(x, n) as scale, round half away from zero, unscale.

    Rounding the scaled double matches the SQL engine's ROUND on doubles
    bit for bit; rounding the exact decimal expansion does not (1.005).
    """
    scale = float(10**digits)
    return F.round(_c(c) * F.lit(scale), 0) / F.lit(scale)


def as_ntz(c: Column | str) -> Column:
    return _c(c).cast(T.TimestampNTZType())


def _in_range(c: Column) -> Column:
    return F.when(c.between(F.lit(TS_MIN), F.lit(TS_MAX)), c)


def coerce_timestamp(c: Column | str, dtype: T.DataType, formats: Sequence[str]) -> Column:
    """Parse to a naive timestamp; unparseable or out-of-range values become null.

    Text is tried against each declared format in order (``try_to_timestamp``
    never throws under ANSI); typed dates and timestamps are cast.
    """
    c = _c(c)
    if isinstance(dtype, T.StringType):
        parsed = F.coalesce(*[in_utc(as_ntz(F.try_to_timestamp(c, F.lit(f))), c, f) for f in formats])
        return _in_range(parsed)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return _in_range(as_ntz(c))
    return F.lit(None).cast(T.TimestampNTZType())


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact microseconds from ``start`` to ``end`` (bigint, signed)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Fractional signed minutes from ``start`` to ``end``."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_MINUTE))


def _day_quotient(start: Column | str, end: Column | str) -> Column:
    # decimal keeps the division exact for any span a timestamp can hold
    us = micros_between(start, end).cast("decimal(20,0)")
    return us / F.lit(MICROS_PER_DAY).cast("decimal(20,0)")


def days_floor(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, rounded toward minus infinity."""
    return F.floor(_day_quotient(start, end)).cast("bigint")


def days_trunc(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, rounded toward zero."""
    return _day_quotient(start, end).cast("bigint")


def month_start(c: Column | str) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(c).cast("date"), "month")


def month_start_ts(c: Column | str) -> Column:
    """First instant of the month as a naive timestamp."""
    return as_ntz(month_start(c))


def week_start(c: Column | str) -> Column:
    """Monday of the ISO week as DATE, independent of the session time zone."""
    d = _c(c).cast("date")
    return F.date_sub(d, (F.dayofweek(d) + F.lit(5)) % F.lit(7))


def flag(cond: Column) -> Column:
    """Boolean to 0/1 bigint with null counted as 0."""
    return F.coalesce(cond, F.lit(False)).cast("bigint")
