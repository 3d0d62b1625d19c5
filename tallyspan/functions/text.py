"""JVM-side text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_WIDTH = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　"
HALF_WIDTH = "".join(map(chr, range(0x21, 0x7F))) + " "
#: Java regex class of everything that counts as white-space here, a byte order mark excluded.
SPACE = r"[\s\p{Z}\x85\x{200B}]"
#: The same characters one by one, for trimming without a pattern.
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000"


def fold_width(c: Column) -> Column:
    """Full-width ASCII forms and the ideographic space to their half-width forms."""
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


def trim_space(c: Column) -> Column:
    """Trim every kind of white-space, not only U+0020."""
    return F.btrim(c, F.lit(SPACES))


def trim_header(c: Column) -> Column:
    """Trim white-space and byte order marks around a column header."""
    return F.btrim(c, F.lit(SPACES + "\ufeff"))


def is_blank(c: Column) -> Column:
    return F.coalesce(trim_space(c), F.lit("")) == ""
