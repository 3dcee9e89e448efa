"""String clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a field.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space at both ends (``trim`` alone removes only blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_start(text: Column) -> Column:
    """Remove white space at the start; much cheaper on long text than at the end."""
    return F.ltrim(text, F.lit(WHITESPACE))


def drop_bad_bytes(text: Column) -> Column:
    """Remove byte sequences that are not UTF-8; valid text is left untouched."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.regexp_replace(text, "\ufffd", ""))
