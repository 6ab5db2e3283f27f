from tiffin.functions.scalar import (
    half_up_ratio,
    is_true,
    joined_sorted,
    label_month,
    sum_where,
    whole_hours,
    whole_minutes,
)

__all__ = [
    "half_up_ratio",
    "is_true",
    "joined_sorted",
    "label_month",
    "sum_where",
    "whole_hours",
    "whole_minutes",
]
