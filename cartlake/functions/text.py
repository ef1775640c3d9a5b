"""Text columns: presence, white space, hash keys, truncation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space that the SQL dialect of the models trims. The
# built-in `trim` takes off blanks only.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def trim_space(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE_SPACE))


def present(text: Column) -> Column:
    """Neither null nor empty; blanks count as present."""
    return text.isNotNull() & (text != "")


def or_default(value: Column, default) -> Column:
    """Replaces null only; an empty text stays as it is."""
    return F.coalesce(value, F.lit(default))


def hash_key(text: Column) -> Column:
    """Upper-case hex MD5 of the UTF-8 bytes."""
    return F.upper(F.md5(text.cast("binary")))


def cut(text: Column, length: int = 2000) -> Column:
    return F.left(text, F.lit(length))
