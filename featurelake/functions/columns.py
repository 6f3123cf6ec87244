"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000

# Timestamp formats besides the ISO-like ones (month before day).
TEXT_TIMESTAMPS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "MMM d, yyyy H:mm:ss", "MMM d, yyyy", "yyyyMMdd HHmmss", "yyyyMMdd",
                   "yyyy/M/d H:mm:ss", "yyyy/M/d")

# Numbers written with a trailing type letter (``1.0d``, ``2f``) are accepted
# by the JVM parser but are not numbers for the pipeline; reject them.  The
# only valid numeric words ending in such a letter are the infinities.
_TYPE_LETTERS = ("d", "f")
_INF_WORDS = ("inf", "+inf", "-inf")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Text -> DOUBLE; anything unparseable (and NaN) -> null."""
    s = F.trim(col_of(c).cast("string"))
    d = s.try_cast("double")
    lowered = F.lower(s)
    typed_literal = F.substring(lowered, -1, 1).isin(*_TYPE_LETTERS) & ~lowered.isin(*_INF_WORDS)
    return F.when(typed_literal | F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def as_timestamp(c) -> Column:
    """TIMESTAMP_NTZ / TIMESTAMP / text -> TIMESTAMP (session zone = UTC).

    Text is ISO-like (``yyyy-MM-dd HH:mm:ss``, with offset or without) or in
    one of ``TEXT_TIMESTAMPS``, the first that fits; other text becomes null.
    """
    c = col_of(c)
    text = F.trim(c.cast("string"))
    return F.coalesce(c.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in TEXT_TIMESTAMPS])


def ts_literal(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp")


def elapsed_days(later, earlier) -> Column:
    """Whole days elapsed, floored (−1 hour is −1 day, like a timedelta)."""
    diff = F.unix_micros(as_timestamp(later)) - F.unix_micros(as_timestamp(earlier))
    return F.floor(diff / F.lit(float(MICROS_PER_DAY))).cast("long")


def clip(c, lo: float, hi: float) -> Column:
    """Clip into [lo, hi] keeping null as null (greatest/least alone skip nulls)."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def safe_div(a, b) -> Column:
    """Division that yields null instead of raising (ANSI) on a zero divisor."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def ts_text(c) -> Column:
    """Portable text for a timestamp (microseconds, UTC)."""
    return F.date_format(as_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Missing numeric values -> 0 (integral and floating columns only)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.na.fill(0, subset=numeric) if numeric else df


# Fixed value: just over a half, so that the last bit of a sum, which depends on
# the order of its terms, cannot decide how an exact half is rounded.
HALF_UP = 0.5001220703125


def round_half_up(c, digits: int = 6) -> Column:
    """Round with plain IEEE arithmetic, floor(x * 10^d + HALF_UP) / 10^d, so
    any engine doing the same double operations returns the same bits.  Sums of a
    billion and more have no sixth decimal: from 1e9 on two decimals stay, from
    1e15 on millions, from 1e18 on units of 1e12, and from 1e30 on (and for
    infinities) the value itself."""
    c = col_of(c).cast("double")

    def to(scale: float) -> Column:
        return F.floor(c * F.lit(scale) + F.lit(HALF_UP)).cast("double") / F.lit(scale)

    def units(unit: float) -> Column:
        return F.floor(c / F.lit(unit) + F.lit(HALF_UP)).cast("double") * F.lit(unit)

    size = F.abs(c)
    return (F.when(size < 1e9, to(float(10 ** digits))).when(size < 1e15, to(100.0))
             .when(size < 1e18, units(1e6)).when(size < 1e30, units(1e12)).otherwise(c)).alias("r")


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form for cross-engine comparison: doubles rounded, timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_half_up(c, digits).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(ts_text(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
