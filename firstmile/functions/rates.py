"""Percentages. An empty denominator gives NULL, not an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def rounded_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(percent(part, whole), digits)


def rounded_loss_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 minus the share, rounded once from the unrounded share."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round((F.lit(1.0) - share) * F.lit(100.0), digits)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one wall-clock moment to another; NULL if either is."""
    return F.timestamp_diff("SECOND", start, end)
