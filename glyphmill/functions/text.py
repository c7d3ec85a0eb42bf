"""Text expressions: tokens and the stable per-text unit value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word character is a Unicode letter, a Unicode number or "_".
# (Java's bare \w is ASCII only.)
WORD = r"[\p{L}\p{N}_]"


def filled(text: Column) -> Column:
    """Missing text is treated as empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def tokens(text: Column) -> Column:
    """All maximal runs of word characters, in text order."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))


def stable_unit(text: Column) -> Column:
    """A reproducible value in [0, 1]: the first 8 hex digits of SHA-256 over their maximum."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))
