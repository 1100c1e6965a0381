"""Rounding and order-independent averages of doubles, in plain double arithmetic.

``F.round`` on a double and a cast to decimal both go through a decimal string
for every row, more than ten times the cost of the arithmetic below, and
``F.round`` also rounds the printed text (1.005 -> 1.01) where SQL engines round
the scaled double (1.005 -> 1.0). The expressions are kept short on purpose: a
generated method above 8,000 bytes of bytecode is interpreted, not compiled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From here on every double is a whole number.
_WHOLE = float(2**52)

# The largest double below one half: adding it instead of 0.5 keeps the sum of
# 0.49999999999999994 and itself below one, and every exact half still rounds up.
_HALF = 0.49999999999999994


def round_to(value: Column, places: int = 0) -> Column:
    """``value`` scaled, rounded half away from zero and scaled back."""
    scaled = value * float(10**places) if places else value
    rounded = F.signum(scaled) * F.floor(F.abs(scaled) + _HALF)
    # The test is false for NaN, infinity and doubles that are already whole.
    return F.when(F.abs(scaled) < _WHOLE, rounded / float(10**places)).otherwise(value)


# Decimals an average is rounded to before it is rounded for good.
_AVERAGE_PLACES = 9


def round_average(average: Column, places: int) -> Column:
    """An average to ``places`` decimals, halves away from zero as in decimal arithmetic.

    The mean of 19.24 and 19.25 may come out as 19.244999999999997 or 19.245,
    depending on the order of a sum; rounding to 9 decimals first makes both a half.
    """
    return round_to(round_to(average, _AVERAGE_PLACES), places)


# Adding and subtracting it rounds a double to a multiple of 2**-10.
_GRID = 1.5 * 2.0**42


def coarse_part(value: Column) -> Column:
    """``value`` rounded to a multiple of 2**-10, which sums of doubles hold without loss.

    Values from 2**43 on keep what a sum next to the grid leaves of them.
    """
    return (value + _GRID) - _GRID


def fine_part(value: Column) -> Column:
    """The rest of ``value``, exact; 0 for infinity and NaN, which the coarse part carries."""
    coarse = coarse_part(value)
    return F.when(coarse == value, 0.0).otherwise(value - coarse)


def steady_avg(value: Column) -> Column:
    """``AVG`` in full precision whose bits do not depend on the order of the rows.

    A double sum depends on the order in which partial results meet. The coarse
    parts add up without rounding while their sum stays below 2**43, and what
    rounding the fine parts suffer is far below the last bit of the result.
    Beyond that, as for infinity and NaN, it is a plain double sum.
    """
    return (F.sum(coarse_part(value)) + F.sum(fine_part(value))) / F.count(value)


def steady_avg_over(value: Column, window) -> Column:
    """``steady_avg`` as a window expression."""
    total = F.sum(coarse_part(value)).over(window) + F.sum(fine_part(value)).over(window)
    return total / F.count(value).over(window)
