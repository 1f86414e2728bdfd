from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowledger.functions.numeric import ratio_half_even, ratio_half_up

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_MINUTE = 60_000_000


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds from start to end; 0 where either is null or the span is negative."""
    span = F.unix_micros(end) - F.unix_micros(start)
    return F.greatest(F.coalesce(span, F.lit(0)), F.lit(0))


def micros_to_hours(micros: Column) -> Column:
    return micros / F.lit(float(MICROS_PER_HOUR))


def micros_to_minutes(micros: Column) -> Column:
    """Minutes to two digits, ties to even."""
    return ratio_half_even(micros, MICROS_PER_MINUTE)


def stored_hours(micros: Column) -> Column:
    """Hours as the tables keep them: two digits, ties up."""
    return ratio_half_up(micros, F.lit(MICROS_PER_HOUR))


def calendar_date(instant: Column) -> Column:
    return F.to_date(instant)


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic: no text is formatted per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(date_key_col: Column) -> Column:
    return F.call_function("div", date_key_col, F.lit(100)).cast("int")
