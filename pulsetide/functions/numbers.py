"""Numbers: rounding, presence and the trend label."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsetide.model import TREND_EPSILON, TREND_THRESHOLD


def formatted(value: Column, pattern: str) -> Column:
    """Decimal text of a double, rounded half-even on its exact binary value."""
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def round_half_even(value: Column) -> Column:
    """Two places as Python's ``round`` gives them: 2.675 is 2.67 and 0.125 is 0.12.

    ``F.round`` rounds the shortest decimal text half-up, which differs in both cases.
    Doubles too large for hundredths, infinite ones among them, are already rounded.
    """
    return F.when(F.abs(value) < 1e15, formatted(value, "0.00").cast("double")).otherwise(value)


def present(value: Column) -> Column:
    """Neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def trend(count: Column, first_mean: Column, second_mean: Column) -> Column:
    """Label of the relative change from the earlier to the later half of a series."""
    change = (second_mean - first_mean) / (first_mean + F.lit(TREND_EPSILON))
    return (
        F.when((count < 2) | F.isnan(change), "stable")
        .when(change > TREND_THRESHOLD, "increasing")
        .when(change < -TREND_THRESHOLD, "decreasing")
        .otherwise("stable")
    )
