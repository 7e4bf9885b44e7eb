"""Column expressions shared by the operators."""

from regiopanel.functions.dates import day_from_parts, day_from_text, day_text, month_window
from regiopanel.functions.rounding import int_div, ratio_or_zero, round_ratio
from regiopanel.functions.text import decimal_comma, padded_key, percent_text, plain_decimal

__all__ = [
    "day_from_parts",
    "day_from_text",
    "day_text",
    "decimal_comma",
    "int_div",
    "month_window",
    "padded_key",
    "percent_text",
    "plain_decimal",
    "ratio_or_zero",
    "round_ratio",
]
