"""Text classes as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are.

    ``lower`` changes nothing else in pure ASCII and is several times as fast.
    """
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space; none for the empty text."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def content_key(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns, nulls included."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
