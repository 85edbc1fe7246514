"""Exact rates. Segment limits are compared on decimals: 0.48 - 0.45 >= 0.03 is false in doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole at six decimals, rounded half up; null when ``whole`` is zero."""
    divisor = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (part.cast("decimal(20,0)") / divisor).cast("decimal(38,6)")


def mean(value: Column) -> Column:
    """Aggregate: mean of an integer column at six decimals.

    Sum and count are long buffers, cheaper to combine map-side than a decimal average.
    """
    return ratio(F.sum(value), F.count(value))


def minutes(seconds: Column) -> Column:
    """Seconds (six decimals) as minutes at twelve decimals."""
    return (seconds.cast("decimal(28,14)") / F.lit(60).cast("decimal(2,0)")).cast("decimal(38,12)")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
