"""Column expressions shared by the operators."""

from pulsetide.functions.labels import (
    display_number,
    metric_label,
    padded_user_id,
    user_label,
)
from pulsetide.functions.numbers import present, round_half_even, trend
from pulsetide.functions.times import event_date, event_time, instant, iso_text

__all__ = [
    "display_number",
    "event_date",
    "event_time",
    "instant",
    "iso_text",
    "metric_label",
    "padded_user_id",
    "present",
    "round_half_even",
    "trend",
    "user_label",
]
