"""Masking of personal columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def masked_email(email: Column) -> Column:
    """First character and domain stay readable; text without ``@`` is masked whole."""
    at = F.instr(email, "@")
    kept = F.concat(F.substring(email, 1, 1), F.lit("***@"), F.substring_index(email, "@", -1))
    return F.when(at > 1, kept).when(email.isNotNull(), F.lit("***"))


def masked_phone(phone: Column) -> Column:
    """Every digit but those in the last four characters is replaced; all of them in a short number.

    Text without a digit is masked whole, so the result never equals the input.
    """
    digits = F.length(F.regexp_replace(phone, "[^0-9]", ""))
    long = F.concat(F.regexp_replace(F.substring(phone, F.lit(1), F.greatest(F.length(phone) - 4, F.lit(0))), "[0-9]", "*"),
                    F.right(phone, F.lit(4)))
    return (F.when(digits == 0, F.lit("***")).when(digits <= 4, F.regexp_replace(phone, "[0-9]", "*"))
            .otherwise(long))


def masked_text(text: Column) -> Column:
    return F.mask(text)


def pseudonym(text: Column, salt: str = "") -> Column:
    """Stable one-way key for joining masked tables."""
    return F.sha2(F.concat(F.lit(salt), text), 256)
