"""Address and free-text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_newlines(text: Column) -> Column:
    # A plain replace works on bytes; translate and regular expressions decode.
    return F.replace(text, F.lit("\n"), F.lit(" "))


def collapse_whitespace(text: Column) -> Column:
    """Every run of whitespace, newlines included, becomes one space."""
    return F.regexp_replace(text, r"\s+", " ")
