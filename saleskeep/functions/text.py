"""Text clean-up in the two dialects the quality rules need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a general-purpose strip removes, beyond the plain space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def filled(text: Column) -> Column:
    """Text without outer spaces, NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def match_key(text: Column) -> Column:
    """Key under which two spellings count as the same value."""
    return F.lower(F.trim(text))


def catalog_key(text: Column) -> Column:
    """The same key of a catalog entry, whose leading spaces count."""
    return F.lower(F.rtrim(text))


def stripped(text: Column) -> Column:
    """Text without outer whitespace of any kind; NULL counts as blank."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
