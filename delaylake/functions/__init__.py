"""Column functions: every one returns a ``Column`` that stays inside whole-stage code generation."""

from .calendar import day_name, day_of_week, local_hour, month_name, month_number
from .casting import bool_map, to_calendar_date, to_integer, to_text, to_utc_timestamp
from .delay import (
    delay_category,
    delay_minutes,
    is_cancelled,
    is_delayed,
    is_landed,
    is_major_delay,
    time_block,
)
from .numbers import clip_and_round, elapsed_micros, elapsed_seconds, percentage, ratio
from .text import (
    array_to_braces,
    braces_to_value,
    delay_code_to_braces,
    last_element,
    map_value,
    normalised_code,
)

__all__ = [
    "array_to_braces",
    "bool_map",
    "braces_to_value",
    "clip_and_round",
    "day_name",
    "day_of_week",
    "delay_category",
    "delay_code_to_braces",
    "delay_minutes",
    "elapsed_micros",
    "elapsed_seconds",
    "is_cancelled",
    "is_delayed",
    "is_landed",
    "is_major_delay",
    "last_element",
    "local_hour",
    "map_value",
    "month_name",
    "month_number",
    "normalised_code",
    "percentage",
    "ratio",
    "time_block",
    "to_calendar_date",
    "to_integer",
    "to_text",
    "to_utc_timestamp",
]
