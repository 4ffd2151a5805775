"""String helpers that stay in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes. Spark's plain trim
# removes U+0020 only, and Java's \s leaves U+001C..U+001F alone.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column | str) -> Column:
    """Remove leading and trailing white space, Unicode-wide, in linear time."""
    return F.trim(F.col(value) if isinstance(value, str) else value, F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    """True for NULL and the empty string: the two keys that name no record."""
    column = F.col(value) if isinstance(value, str) else value
    return column.isNull() | (column == "")
