"""Text expressions shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern, and the white space of Unicode strings as a
# Java character class.
TOKEN_PATTERN = "[a-z0-9]+"
SPACE_CLASS = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def tokens(text: Column | str) -> Column:
    """All ASCII letter/digit runs of the lower-cased text, in order, repeats kept."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_set(text: Column | str) -> Column:
    return F.array_distinct(tokens(text))


def strip_space(text: Column) -> Column:
    """Trim all white space; Spark's ``trim`` only takes spaces."""
    return F.regexp_replace(text, rf"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def sentences(text: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(text, rf"(?<=[.!?]){SPACE_CLASS}+")


def hash_bucket(token: Column) -> Column:
    """Bucket 0..255 of a token: the first byte of its md5, the same on every machine."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 2), 16, 10).cast("int")
