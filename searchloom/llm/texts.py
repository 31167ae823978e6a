"""Small column helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: what separates words of lower-cased letters and digits: every other ASCII character
ASCII_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same before lower-casing
CASED_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: what separates words cut at white space
SPACES = r"[\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, gaps: str) -> Column:
    """Words between gaps, in order. Splitting copies each word once; extracting matches would copy the text for each."""
    return F.array_remove(F.split(text, gaps), "")


def hex_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def named(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_of(names: list[str]) -> Column:
    """All columns as one struct, so that no name of theirs can clash with a helper column."""
    return F.struct(*[named(c) for c in names])
