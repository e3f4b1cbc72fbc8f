"""Column expressions. Each takes and returns Columns; nothing here runs a job."""

from firstmile.functions.rates import percent, rounded_percent
from firstmile.functions.text import collapse_whitespace, strip_newlines
from firstmile.functions.time import (
    at_midnight,
    in_onboarding,
    iso_week_label,
    iso_year,
    month_label,
    onboarding_end,
)
from firstmile.functions.convert import code, flag, number, timestamp

__all__ = [
    "at_midnight",
    "code",
    "collapse_whitespace",
    "flag",
    "in_onboarding",
    "iso_week_label",
    "iso_year",
    "month_label",
    "number",
    "onboarding_end",
    "percent",
    "rounded_percent",
    "strip_newlines",
    "timestamp",
]
