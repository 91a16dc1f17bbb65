"""Column expressions on texts that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of anything but ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"
# Runs of ASCII digits, lower-case ASCII letters and everything outside ASCII; for lowered texts. Java's negated classes
# of several ranges cost about fourteen times as much as this one, which names the same code points.
LETTERS = r"[a-z0-9\x{80}-\x{10FFFF}]+"


def text_of(column: str | Column = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed. Pure ASCII goes through the faster `lower`."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(slow)


def words_of(text: Column, pattern: str) -> Column:
    """All matches of the pattern in order; an empty array for a text without any."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def crc_mod(key: Column, divisor: int) -> Column:
    """crc32 of a key as text, modulo a divisor; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor
