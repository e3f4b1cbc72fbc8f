"""Declared schemas: raw extracts, clean tables, and the published contracts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS = T.TimestampNTZType()


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": TS,
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, name type". A DDL parser would need a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns a raw extract must have. Everything is text until converted.
RAW_USERS = _struct("user_id string, type string, rubro string, address string")
RAW_TRANSACTIONS = _struct(
    "user_id string, transaction_dt string, type string, segment string"
)
RAW_ONBOARDING = _struct(
    "user_id string, first_login_dt string, week_year string,"
    " habito string, habito_dt string, activacion string, activacion_dt string,"
    " setup string, setup_dt string, return string, return_dt string"
)

CLEAN_USERS = _struct("user_id string, type double, rubro double, address string")
CLEAN_TRANSACTIONS = _struct(
    "user_id string, transaction_dt timestamp, type int, segment int"
)
CLEAN_ONBOARDING = _struct(
    "user_id string, first_login_dt timestamp, week_year string,"
    " habito int, habito_dt timestamp, activacion int, activacion_dt timestamp,"
    " setup int, setup_dt timestamp, return_flag int, return_dt timestamp"
)


@dataclass(frozen=True)
class Contract:
    """A published table: column order and types, unique key, order in a file."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    sort: tuple[str, ...] = ()

    def order(self) -> list[Column]:
        """Sort columns; a leading minus means descending."""
        return [
            F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc()
            for c in (self.sort or self.key)
        ]

    def with_type(self, declared: T.DataType, stored: T.DataType) -> Contract:
        """The same table with every `declared` column as `stored`."""
        fields = [
            T.StructField(f.name, stored, f.nullable) if f.dataType == declared else f
            for f in self.schema.fields
        ]
        return replace(self, schema=T.StructType(fields))

    def with_instants(self) -> Contract:
        """Zoned timestamps, for stores without a wall-clock type."""
        return self.with_type(TS, T.TimestampType())

    def with_wide_counts(self) -> Contract:
        """BIGINT for INT, for users with over two billion transactions."""
        return self.with_type(T.IntegerType(), T.LongType())


_BUCKET_COLUMNS = (
    " user_segment string, total_users bigint, returned_users bigint,"
    " activated_users bigint, setup_completed_users bigint, habit_achieved_users bigint,"
    " drop_rate double, activation_rate double, setup_rate double, habit_rate double"
)

USER_SEGMENTS = Contract(
    "user_segments",
    _struct(
        "user_id string, user_segment string, total_transactions int,"
        " unique_transaction_types int, transaction_days int,"
        " first_transaction_dt timestamp, last_transaction_dt timestamp"
    ),
    key=("user_id",),
)
USER_METRICS = Contract(
    "user_metrics",
    _struct(
        "user_id string, first_login_dt timestamp, week_year string,"
        " user_segment string, total_transactions int, transaction_days int,"
        " drop_flag int, return_flag int, return_dt timestamp,"
        " activation_validated int, activacion_dt timestamp,"
        " habit_validated int, total_transactions_period int,"
        " unique_transaction_days int, setup_achieved int, setup_dt timestamp,"
        " onboarding_end_dt timestamp, first_login_month int, first_login_week int"
    ),
    key=("user_id",),
)
FUNNEL_ANALYSIS = Contract(
    "funnel_analysis",
    _struct(
        "dimension_type string, dimension_value string, total_users bigint,"
        " stage_1_registered bigint, stage_2_returned bigint, stage_3_activated bigint,"
        " stage_4_setup bigint, stage_5_habit bigint"
    ),
    key=("dimension_type", "dimension_value"),
)
MONTHLY_METRICS = Contract(
    "monthly_metrics",
    _struct("year_month string," + _BUCKET_COLUMNS),
    key=("year_month", "user_segment"),
)
WEEKLY_METRICS = Contract(
    "weekly_metrics",
    _struct("year_week string," + _BUCKET_COLUMNS),
    key=("year_week", "user_segment"),
)
TRANSACTION_SUMMARY = Contract(
    "transaction_summary",
    _struct(
        "user_id string, transaction_date date, transaction_count int,"
        " payment_transactions int, collection_transactions int,"
        " unique_transaction_types int"
    ),
    key=("user_id", "transaction_date"),
    sort=("user_id", "-transaction_date"),
)

CONTRACTS = {
    c.name: c
    for c in (
        USER_SEGMENTS,
        USER_METRICS,
        FUNNEL_ANALYSIS,
        MONTHLY_METRICS,
        WEEKLY_METRICS,
        TRANSACTION_SUMMARY,
    )
}


class SchemaMismatch(ValueError):
    """A table lacks a declared column or has it with another type."""


def missing_columns(df: DataFrame, expected: T.StructType | list[str]) -> list[str]:
    names = expected if isinstance(expected, list) else expected.names
    return [n for n in names if n not in df.columns]


def schema_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """Readable differences in names and types; empty when `df` conforms."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in have:
            problems.append(f"{field.name}: missing")
        elif have[field.name] != field.dataType:
            found = have[field.name].simpleString()
            problems.append(f"{field.name}: {found}, not {field.dataType.simpleString()}")
    return problems


def require(df: DataFrame, expected: T.StructType | list[str], table: str) -> DataFrame:
    """`df`, or an error naming every missing column."""
    absent = missing_columns(df, expected)
    if absent:
        raise SchemaMismatch(f"{table} lacks {', '.join(absent)}")
    return df


def declared(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """The declared columns and no others, in the declared types."""
    require(df, expected, table)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in expected.fields])


def _stored(df: DataFrame, field: T.StructField, table: str) -> Column:
    """A column as the contract declares it. A count too large for INT is an
    error in every session, also where casts would wrap."""
    value = F.col(field.name)
    narrowed = isinstance(df.schema[field.name].dataType, T.LongType) and isinstance(
        field.dataType, T.IntegerType
    )
    if not narrowed:
        return value.cast(field.dataType).alias(field.name)
    fits = value.between(-(2**31), 2**31 - 1) | value.isNull()
    error = F.raise_error(F.lit(f"{table}.{field.name} does not fit INT")).cast("int")
    return F.when(fits, value.cast("int")).otherwise(error).alias(field.name)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project to the contract's columns, order and types."""
    require(df, contract.schema, contract.name)
    return df.select(*[_stored(df, f, contract.name) for f in contract.schema.fields])


def schema_listing(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )
