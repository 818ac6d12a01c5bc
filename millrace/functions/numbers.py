"""Rounding, sums and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def round_half_away(value: Column, places: int = 2) -> Column:
    """Round a double by scaling it first.

    ``F.round(1.005, 2)`` works on the printed digits and gives 1.01; warehouses
    that scale the binary value give 1.0. This is the second rule.
    """
    value = value.cast("double")
    if places == 0:
        return F.round(value)
    scale = F.lit(float(10**places))
    return F.round(value * scale) / scale


SETTLED = 6


def settled_sum(value: Column, places: int = SETTLED) -> Column:
    """Sum of doubles, whole values as they are; NaN and infinity stay what they are.

    Additions in another order (a retry, another partitioning) move the last digits
    of such a sum. The result, never a value, is therefore rounded to `places` decimals,
    which reports then round further; totals of money in the thousands of millions take two.
    """
    return F.round(F.sum(value.cast("double")), places)


def settled_mean(value: Column) -> Column:
    """Average over the non-null rows, the result rounded like that of `settled_sum`; NULL when there are none."""
    return F.round(F.avg(value.cast("double")), SETTLED)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL where whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, rounded."""
    return round_half_away(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), places)


def decimal_ratio(part: Column, whole: Column, places: int, result: DecimalType) -> Column:
    """part / whole of two decimals, rounded half away from zero; NULL where whole is zero.

    Spark gives the quotient scale(part) + precision(whole) + 1 decimals while 38
    digits hold it, which is fine enough that the first rounding cannot create a
    tie for the second one. Callers cast their operands so that it does fit.
    """
    return F.round(F.try_divide(part, whole), places).cast(result)


def decimal_average(total: Column, count: Column, result: DecimalType) -> Column:
    """Average from a sum of two-decimal values and its count (fewer than 10**13 rows)."""
    return decimal_ratio(total.cast(DecimalType(24, 2)), count.cast(DecimalType(13, 0)), result.scale, result)
