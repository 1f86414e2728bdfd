"""Exact two-digit results from integers.

Sums of doubles depend on the order in which partitions arrive, so a mean that lies near a rounding
border could change from run to run. All stored means and durations are therefore computed from
integer sums and rounded once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

STORED = "decimal(12,2)"
SCORE = "decimal(5,2)"
_WIDE = "decimal(19,0)"


def _from_hundredths(count: Column, dtype: str) -> Column:
    return (count.cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast(dtype)


def ratio_half_up(numerator: Column, denominator: Column, dtype: str = STORED) -> Column:
    """numerator / denominator, both non-negative integers, rounded half up to two digits."""
    hundredths = F.call_function("div", 200 * numerator + denominator, 2 * denominator)
    return _from_hundredths(hundredths, dtype)


def ratio_half_even(numerator: Column, denominator: int, dtype: str = STORED) -> Column:
    """The same for a constant even denominator divisible by 100, rounded half to even."""
    unit = denominator // 100
    whole = F.call_function("div", numerator, F.lit(unit))
    rest = numerator % unit
    up = (rest > unit // 2) | ((rest == unit // 2) & (whole % 2 == 1))
    return _from_hundredths(whole + up.cast("bigint"), dtype)


_LOW_BITS = 30
_SUM = "decimal(29,0)"


def exact_sum(col: Column) -> Column:
    """Integer sum beyond 64 bits, added up in two halves of 64 bits: that takes a fraction of the time and the
    space of a decimal sum. A half that should overflow (no group of a billion rows does) is an error."""
    whole = col.cast("bigint")
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast(_WIDE)
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast(_WIDE)
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + low).cast(_SUM)


def mean_half_up(total: Column, rows: Column, unit: int = 1, dtype: str = STORED) -> Column:
    """Mean of integers given as their sum, in units of `unit`."""
    return ratio_half_up(total, rows.cast(_WIDE) * F.lit(unit).cast("decimal(10,0)"), dtype)
