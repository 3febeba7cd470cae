"""Percentages and ratios rounded half-up to two places, NULL instead of division by zero.

The factor 100 is multiplied in before the only division, so a value that lies exactly on
half a cent rounds up, which dividing first and scaling afterwards misses now and then.
"""

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 2)


def percent(part: Column, whole: Column) -> Column:
    return ratio(F.lit(100.0) * part, whole)


def percent_change(current: Column, previous: Column) -> Column:
    """Change against `previous`; 0.0 where there is no previous value or it is zero."""
    known = previous.isNotNull() & (previous != 0)
    return F.when(known, percent(current - previous, previous)).otherwise(F.lit(0.0))
