"""ANSI-safe conversions of dirty columns.

Raw extracts arrive as strings (CSV) or already typed (Parquet). A conversion
of a column that already has the type is the bare column, so filters on it
still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def number(df: DataFrame, name: str) -> Column:
    """Double; NULL for blank or non-numeric text."""
    kind = _type_of(df, name)
    if isinstance(kind, T.DoubleType):
        return F.col(name)
    if isinstance(kind, T.StringType):
        return F.nullif(F.trim(F.col(name)), F.lit("")).try_cast("double")
    return F.col(name).try_cast("double")


def code(df: DataFrame, name: str) -> Column:
    """Integer code; "3" and "3.0" are 3, while "3.5" and "x" are NULL."""
    if isinstance(_type_of(df, name), T.IntegralType):
        return F.col(name)
    value = number(df, name)
    return F.when(value == F.floor(value), value.try_cast("int"))


def a_flag(df: DataFrame, name: str) -> Column:
    """0 or 1; NULL for any other value."""
    value = F.col(name) if isinstance(_type_of(df, name), T.IntegralType) else number(df, name)
    return F.when(value.isin(0, 1), value.cast("int"))


def flag(df: DataFrame, name: str) -> Column:
    """1 for a one, in digits or as text; 0 for everything else, missing or not."""
    kind = _type_of(df, name)
    value = F.col(name) if isinstance(kind, T.IntegralType) else number(df, name)
    return F.when(value == 1, F.lit(1)).otherwise(F.lit(0))


def timestamp(df: DataFrame, name: str) -> Column:
    """Wall-clock timestamp; NULL for unreadable text. Typed columns pass."""
    if isinstance(_type_of(df, name), T.StringType):
        return F.trim(F.col(name)).try_cast("timestamp_ntz")
    return F.col(name)
