from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as whitespace when text is stripped.
BLANKS = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all kinds of whitespace at both ends (plain `trim` removes spaces only)."""
    return F.btrim(text, F.lit(BLANKS))
