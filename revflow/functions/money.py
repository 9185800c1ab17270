"""Money text and plain numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


# A failed cast costs an exception per row, so blanks, the common case, are
# told apart before it.


def _checked(raw: Column, parsed: Column, strict: bool) -> Column:
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("not a number: "), raw))
    return F.when(raw.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def money(raw: Column, strict: bool = False, as_type: str = MONEY) -> Column:
    """``$1,234.50`` as a decimal; what cannot be read is NULL, or an error when strict."""
    text = raw.cast("string")
    plain = F.replace(F.replace(text, F.lit("$")), F.lit(","))
    return _checked(text, F.when(text != "", plain.try_cast(as_type)), strict)


def number(raw: Column, strict: bool = False, as_type: str = MONEY) -> Column:
    """Plain numeric text as a decimal."""
    text = raw.cast("string")
    return _checked(text, F.when(text != "", text.try_cast(as_type)), strict)


def money_rejected(raw: Column) -> Column:
    """True for a present value that is no amount (blank text included)."""
    return raw.isNotNull() & money(raw).isNull()
