"""Word rules shared by the operators, once for Spark columns and once for UTF-8 bytes in tasks."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the output contracts: what separates words. Letters A-Z are lower-cased first, no others.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_ALPHANUMERIC = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_ALPHANUMERIC = (string.ascii_lowercase + string.digits).encode()
_TO_BLANK = bytes(
    b if b >= 0x80 or b in _ALPHANUMERIC else ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalpha() else 0x20
    for b in range(256)
)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes Spark's fast path, other text is translated."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column, separator: str = NOT_ALPHANUMERIC) -> Column:
    """Lower-cased words of a text in order; null or wordless text gives an empty array."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), separator)
    return F.array_remove(parts, "")


def with_words(frame: DataFrame, text: str, name: str = "words") -> DataFrame:
    """Adds the words of a text column. The one-element generator keeps the optimizer from copying the costly expression
    into every place that uses the words."""
    return frame.select("*", F.explode(F.array(split_words(F.col(text)))).alias(name))


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between blanks, as split_words(text, BLANKS): bytes methods know the same blanks and letters."""
    return text.lower().split() if text else []


def alphanumeric_words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, as split_words(text)."""
    return text.translate(_TO_BLANK).split() if text else []
