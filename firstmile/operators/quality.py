"""Profiles and counts of raw tables, each in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstmile.functions import rounded_percent
from firstmile.functions.convert import a_flag, code, number, timestamp
from firstmile.operators.cleaning import drop_index
from firstmile.rules import Rules


def all_columns(df: DataFrame) -> list[Column]:
    """Every column, quoted: headers of extracts may hold dots and spaces."""
    return [_column(name) for name in df.columns]


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _missing(field: T.StructField) -> Column:
    value = _column(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def quality_profile(df: DataFrame) -> DataFrame:
    """Rows, missing values (NULL or NaN) and their percentage, per column."""
    counts = [F.count_if(_missing(f)).alias(f.name) for f in df.schema.fields]
    totals = df.agg(F.count(F.lit(1)).alias("total rows"), *counts)
    tall = totals.unpivot("total rows", all_columns(df), "column_name", "null_count")
    total = F.col("total rows")
    return tall.select(
        "column_name",
        total.alias("total_rows"),
        "null_count",
        (total - F.col("null_count")).alias("non_null_count"),
        rounded_percent(F.col("null_count"), total).alias("missing_percentage"),
    )


def quality_gate(profile: DataFrame, rules: Rules) -> DataFrame:
    """The profile with whether each column stays within the allowed share."""
    within = F.col("missing_percentage") <= F.lit(rules.max_missing_percent)
    return profile.select(
        "column_name",
        "missing_percentage",
        F.when(within, F.lit(1)).otherwise(F.lit(0)).alias("passes"),
    )


def invalid_counts(
    users: DataFrame, transactions: DataFrame, rules: Rules
) -> DataFrame:
    """Rows that break the id, type and segment domains. A NULL breaks none."""
    of_users = users.agg(
        F.count_if(~F.col("user_id").startswith(rules.id_prefix)).alias("id_prefix")
    )
    of_transactions = transactions.agg(
        F.count_if(~F.col("type").isin(*rules.valid_types)).alias("type_domain"),
        F.count_if(~F.col("segment").isin(*rules.segment_codes)).alias("segment_domain"),
    )
    tall_users = of_users.unpivot([], ["id_prefix"], "rule", "invalid_rows")
    tall_transactions = of_transactions.unpivot(
        [], ["type_domain", "segment_domain"], "rule", "invalid_rows"
    )
    return tall_users.select(F.lit("users").alias("dataset"), "*").unionAll(
        tall_transactions.select(F.lit("transactions").alias("dataset"), "*")
    )


def unreadable_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Values that are there but cannot be read as what their column holds.

    Blank and non-numeric codes, unreadable times, flags other than 0 and 1: the
    values that typing turns into NULL, so that no later rule sees them. One pass
    over each raw table; columns that a table lacks are not reported.
    """

    def one(name: str, raw: DataFrame) -> DataFrame:
        readers = {"transaction_dt": timestamp, "first_login_dt": timestamp, "segment": code}
        readers |= {c: a_flag for c in ("habito", "activacion", "setup", "return")}
        readers |= {"type": code, "rubro": number}
        there = [c for c in raw.columns if c in readers]
        counts = raw.agg(
            *[F.count_if(_column(c).isNotNull() & readers[c](raw, c).isNull()).alias(c) for c in there]
        )
        tall = counts.unpivot([], there, "column_name", "unreadable_rows")
        return tall.select(F.lit(name).alias("dataset"), "*")

    return reduce(DataFrame.unionAll, [one(name, df) for name, df in tables.items()])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("dataset"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def duplicate_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, distinct rows and their difference; a saved index does not count."""

    def one(name: str, df: DataFrame) -> DataFrame:
        content = drop_index(df)
        copies = content.groupBy(*all_columns(content)).agg(F.count(F.lit(1)).alias("copies"))
        return copies.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_rows"),
        ).select(
            F.lit(name).alias("dataset"),
            "total_rows",
            "distinct_rows",
            (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        )

    return reduce(DataFrame.unionAll, [one(n, df) for n, df in tables.items()])


def flag_totals(onboarding: DataFrame) -> DataFrame:
    """Users with each flag set, and their share, from the typed extract."""
    flags = ["habito", "activacion", "setup", "return_flag"]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in flags]
    totals = onboarding.agg(F.count(F.lit(1)).alias("total_rows"), *sums)
    return totals.unpivot("total_rows", flags, "flag", "flag_count").withColumn(
        "share", rounded_percent(F.col("flag_count"), F.col("total_rows"))
    )


def date_ranges(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest moment of one time column per table."""
    ranges = [
        df.agg(F.min(c).alias("min_dt"), F.max(c).alias("max_dt")).select(
            F.lit(name).alias("dataset"), "min_dt", "max_dt"
        )
        for name, (df, c) in tables.items()
    ]
    return reduce(DataFrame.unionAll, ranges)


def distribution(df: DataFrame, *names: str) -> DataFrame:
    """Rows per value combination, in key order."""
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count")).orderBy(*names)


def preview(df: DataFrame, order: list[str] | list[Column], rows: int = 10) -> DataFrame:
    """The first rows in a total order, so that every run shows the same ones."""
    return df.orderBy(*order).limit(rows)
