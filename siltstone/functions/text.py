"""Text cleaning and tolerant parsing as Spark column expressions.

Everything here stays inside whole-stage codegen; bad input gives NULL, and the
rule that calls the parser decides whether NULL is acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accepted spellings. Digit groups may be joined by single
# underscores; a one-digit day may be padded with a blank.
ISO_DATE = r"^(?!0000)[0-9]{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12][0-9]|[ 0]?[1-9])$"
INTEGER = r"^[+-]?[0-9]+(?:_[0-9]+)*$"
DECIMAL = (
    r"^[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?$"
)


_BLANKS = "".join(f"\\u{ord(ch):04x}" for ch in WHITESPACE)


def strip(column: str) -> Column:
    """A text column without white space of any kind at its ends.

    Trimming a set of characters is slow, and most values need none: only those
    that begin or end with a blank, a control or a non-ASCII character get it.
    """
    first, last = f"`{column}`", f"substring(`{column}`, -1, 1)"
    plain = " AND ".join(f"{v} >= '!' AND {v} < '\\u007f'" for v in (first, last))
    return F.expr(f"CASE WHEN {plain} THEN `{column}` ELSE btrim(`{column}`, '{_BLANKS}') END")


# The functions below take text that is already stripped; bad input gives NULL.


def is_empty(s: Column) -> Column:
    """True for NULL and empty; never NULL."""
    return F.coalesce(s == "", F.lit(True))


def to_date(s: Column) -> Column:
    """``YYYY-MM-DD`` (leading zeros optional) as DATE, else NULL.

    A bare cast would also accept ``2025`` or a date with a time, hence the guard.
    """
    return F.when(s.rlike(ISO_DATE), F.replace(s, F.lit(" "), F.lit("0")).try_cast("date"))


def to_int(s: Column) -> Column:
    """Whole number as BIGINT, else NULL."""
    return F.when(s.rlike(INTEGER), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


def fits_int(n: Column) -> Column:
    """Whether a parsed BIGINT can be stored in a 32-bit column; never NULL."""
    return F.coalesce(n.between(-(2**31), 2**31 - 1), F.lit(False))


def to_decimal(s: Column, precision: int = 12, scale: int = 2) -> Column:
    """Number as DECIMAL rounded half up, NULL if malformed or out of range."""
    number = F.when(s.rlike(DECIMAL), F.replace(s, F.lit("_"), F.lit("")))
    return number.try_cast(f"decimal({precision},{scale})")


def is_negative(s: Column) -> Column:
    """Sign of a well-formed number before rounding, which would hide -0.001."""
    return F.coalesce(F.replace(s, F.lit("_"), F.lit("")).try_cast("double") < 0, F.lit(False))
