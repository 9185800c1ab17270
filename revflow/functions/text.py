"""Trimming, blanks and missing-value words."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words the CSV reader of pandas 2.2 takes for a missing value.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Every character that counts as white space, not only the blank.
_WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def trim_all(c: Column) -> Column:
    """Strip every kind of white space at both ends (SQL ``trim`` strips blanks only)."""
    return F.btrim(c, F.lit(_WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def trim_to_null(c: Column) -> Column:
    return blank_to_null(trim_all(c))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_WORDS), c)


def strip_trailing_id(c: Column) -> Column:
    """``Doe, J (123)`` as ``Doe, J``; digits elsewhere stay."""
    return F.regexp_replace(c, r"\s*\(\d+\)\z", "")
