from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowledger.constants import MISSING_TOKENS, WHITESPACE


_NOTHING_TO_TRIM = r"(?s)^[!-~](.*[!-~])?$"


def clean(col: Column) -> Column:
    """Text without surrounding white space; null becomes the empty string.

    Trimming against the full white-space set is the most expensive step per cell, so cells that
    begin and end with a printable ASCII character skip it.
    """
    text = col.cast("string")
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
    return F.when(text.rlike(_NOTHING_TO_TRIM), text).otherwise(trimmed)


def clean_lower(col: Column) -> Column:
    return F.lower(clean(col))


def blank_to_null(col: Column) -> Column:
    return F.nullif(clean(col), F.lit(""))


def drop_missing_tokens(col: Column) -> Column:
    """Null for the spellings of 'no value' that a CSV cell may hold."""
    return F.when(~col.isin(*MISSING_TOKENS), col)
