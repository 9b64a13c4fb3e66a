from obs_engine.functions.columns import (
    clock_diff,
    clock_seconds,
    day_of,
    normalised,
    quoted,
    rounded,
    whole_number,
    year_month,
    year_of,
)

__all__ = [
    "clock_diff",
    "clock_seconds",
    "day_of",
    "normalised",
    "quoted",
    "rounded",
    "whole_number",
    "year_month",
    "year_of",
]
