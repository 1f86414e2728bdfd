from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowledger.constants import (
    DECIMAL_NUMBER,
    EARLIEST_INSTANT,
    ISO_TIMESTAMP,
    LATEST_INSTANT,
    TRUE_TOKENS,
)


# The functions below take text that is already `clean`ed, so that it is cleaned once per cell.


def to_flag(text: Column) -> Column:
    """True for the accepted spellings, false for everything else."""
    return F.lower(text).isin(*TRUE_TOKENS)


def to_int(text: Column, default: int, dtype: str = "int") -> Column:
    """Number truncated toward zero; `default` where the text is no number or out of range."""
    number = F.coalesce(text.try_cast(dtype), text.try_cast("double").try_cast(dtype))
    return F.coalesce(F.when(text.rlike(DECIMAL_NUMBER), number), F.lit(default).cast(dtype))


def parse_instant(text: Column) -> Column:
    """ISO-8601 text as a timestamp, null where it is none.

    The pattern guards the cast, which also accepts a bare year or a bare time.
    """
    return F.when(text.rlike(ISO_TIMESTAMP), text.try_cast("timestamp"))


def in_range(instant: Column) -> Column:
    return or_false(
        instant.between(
            F.lit(EARLIEST_INSTANT).cast("timestamp"), F.lit(LATEST_INSTANT).cast("timestamp")
        )
    )


def or_false(condition: Column) -> Column:
    """A comparison with a null operand counts as not met."""
    return F.coalesce(condition, F.lit(False))
