"""Texts for people: user labels, statistic labels, numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsetide.functions.numbers import formatted
from pulsetide.model import STATISTIC_LABELS, USER_ID_PREFIX, USER_LABEL_PREFIX


def user_label(user_id: Column) -> Column:
    """Label of a user: the id without the first ``user_`` in it."""
    first_only = F.regexp_replace(user_id, f"(?s)^(.*?){USER_ID_PREFIX}", "$1")
    return F.concat(F.lit(USER_LABEL_PREFIX), first_only)


def padded_user_id(number: Column, digits: int = 3) -> Column:
    """``user_007``; a number with more digits keeps them all."""
    return F.format_string(f"{USER_ID_PREFIX}%0{digits}d", number)


def metric_label(statistic: str) -> str:
    """Display label of a statistic; one without a label keeps its own name."""
    return STATISTIC_LABELS.get(statistic, statistic)


def display_number(value: Column) -> Column:
    """Whole numbers without decimals, others with two."""
    return F.when(value == F.rint(value), formatted(value, "0")).otherwise(
        formatted(value, "0.00")
    )
