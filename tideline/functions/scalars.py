"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.patterns import ANY_SPACE, INLINE_CHARS, SPACE_CHARS

INFINITY = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as double, NULL on a zero divisor and on overflow."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    quotient = F.try_divide(a, b)
    overflow = (F.abs(quotient) == INFINITY) & (F.abs(a) < INFINITY) & (F.abs(b) < INFINITY)
    return F.when(~F.coalesce(overflow, F.lit(False)), quotient)


def sentinel_to_null(c: Column | str, sentinel: str = ".") -> Column:
    """Text to double, with the missing-value mark as NULL.

    Any other text that is no number raises, whatever the session's settings; it never becomes NULL.
    """
    c = _col(c)
    wrong = F.raise_error(F.concat(F.lit("CAST_INVALID_INPUT: no number: "), c)).cast("double")
    return F.when(c != sentinel, F.coalesce(c.try_cast("double"), wrong))


def regex_extract_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """One capture group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def normalise_text(c: Column | str) -> Column:
    """Runs of whitespace become one space; none is left at either end."""
    return F.trim(F.regexp_replace(_col(c), f"{ANY_SPACE}+", " "))


def strip_text(c: Column | str) -> Column:
    """Whitespace of any kind removed from both ends."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def rstrip_text(c: Column | str) -> Column:
    return F.rtrim(_col(c), F.lit(SPACE_CHARS))


def short_message(c: Column | str, length: int = 200) -> Column:
    """Stripped text cut to ``length`` characters, as kept in error messages."""
    return F.substring(strip_text(c), 1, length)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def starts_with_mark(c: Column | str, mark: str = "#") -> Column:
    """True where the first character of a line that is no whitespace is ``mark``."""
    return F.startswith(F.ltrim(_col(c), F.lit(INLINE_CHARS)), F.lit(mark))


def required(c: Column | str, name: str, data_type: str) -> Column:
    """The value, or an error that stops the job where it is NULL."""
    missing = F.raise_error(F.lit(f"required column {name} is NULL"))
    return F.coalesce(_col(c), missing.cast(data_type))


def utc(at: Column) -> Column:
    """An instant's wall time in UTC, whatever the session's time zone."""
    return F.to_utc_timestamp(at, F.current_timezone())


def days_before(c: Column | str, days: int) -> Column:
    return F.date_sub(_col(c), days)


def years_before(c: Column | str, years: int) -> Column:
    """The same day some years earlier; 29 February falls back to the 28th."""
    return F.add_months(_col(c), -12 * years)
