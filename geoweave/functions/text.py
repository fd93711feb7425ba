"""Token predicates for the text loaders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "^[0-9]+$"
# The characters a text strip removes, and the spellings of a number.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
DECIMAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
INFINITE = r"(?i)^[+-]?inf(?:inity)?$"
NOT_A_NUMBER = r"(?i)^[+-]?nan$"


def strip(col) -> Column:
    """A text without leading and trailing white space of any kind."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(BLANKS))


def tokens(col) -> Column:
    """The comma-separated fields of a stripped line."""
    return F.split(strip(col), ",")


def is_digits(tok: Column) -> Column:
    """ASCII digit test (Unicode digits such as superscripts are rejected)."""
    return strip(tok).rlike(DIGITS)


def try_long(tok: Column) -> Column:
    """BIGINT or NULL (20-digit tokens overflow to NULL, never an error)."""
    return strip(tok).try_cast("long")


def try_double(tok: Column) -> Column:
    """DOUBLE of a decimal, infinite or NaN spelling (digits may be grouped by ``_``), else NULL.

    Spellings that only the JVM knows (``1.0d``, ``2f``, ``0x1p3``) are no numbers.
    """
    t = F.regexp_replace(strip(tok), "(?<=[0-9])_(?=[0-9])", "")
    return (
        F.when(t.rlike(DECIMAL), t.try_cast("double"))
        .when(t.rlike(INFINITE), F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(NOT_A_NUMBER), F.lit(float("nan")))
    )
