"""Onboarding window bounds and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def onboarding_end(first_login: Column, days: int) -> Column:
    """Last day of the window, as DATE: its midnight is the last instant in."""
    return F.date_add(F.to_date(first_login), days)


def at_midnight(df: DataFrame, day: Column, like: str) -> Column:
    """A DATE as the type of column `like`, so no comparison casts implicitly."""
    return day.cast(df.schema[like].dataType)


def in_onboarding(df: DataFrame, event: str, first_login: str, days: int) -> Column:
    """Event not before the first login and not after the closing midnight."""
    end = at_midnight(df, onboarding_end(F.col(first_login), days), like=event)
    return (F.col(event) >= F.col(first_login)) & (F.col(event) <= end)


def iso_year(moment: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), moment).cast("int")


def month_label(year: Column, month: Column) -> Column:
    """2022-01 from two integers."""
    return F.concat_ws("-", _digits(year, 4), _digits(month, 2))


def iso_week_label(year_of_week: Column, week: Column) -> Column:
    """2022-W01 from two integers."""
    return F.concat_ws("-W", _digits(year_of_week, 4), _digits(week, 2))


def _digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")
