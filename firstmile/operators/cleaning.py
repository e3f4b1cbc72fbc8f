"""Cleaning as named rules: the filter and its accounting share one list."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import (
    code,
    collapse_whitespace,
    flag,
    number,
    strip_newlines,
    timestamp,
)
from firstmile.rules import Rules

# The column in which a reader keeps a record of another width, whole.
MALFORMED = "_malformed"
# The column in which a row waits as it was read, for the reject table.
AS_READ = "_as_read"
# Names that exporters give to a saved row index.
INDEX_COLUMNS = ("_c0", "Unnamed: 0")


@dataclass(frozen=True)
class Rule:
    """A row survives when `keep` is true; false and NULL both remove it."""

    name: str
    keep: Column


def drop_index(df: DataFrame) -> DataFrame:
    return df.drop(*INDEX_COLUMNS)


# --- row rules ---------------------------------------------------------------


def right_width(df: DataFrame) -> list[Rule]:
    """The rule that a record had as many fields as the header, where the reader kept
    those that had not."""
    return [Rule("row_width", F.col(MALFORMED).isNull())] if MALFORMED in df.columns else []


def has_prefix(rules: Rules, name: str = "user_id") -> Rule:
    return Rule("id_prefix", F.col(name).startswith(rules.id_prefix))


def has_key(name: str = "user_id") -> Rule:
    return Rule("id_present", F.col(name).isNotNull() & (F.col(name) != ""))


def key_format(rules: Rules, name: str = "user_id") -> Rule:
    return Rule("id_format", F.col(name).rlike(rules.id_pattern))


def type_in_domain(rules: Rules, name: str = "type") -> Rule:
    return Rule("type_domain", F.col(name).isin(*rules.valid_types))


def segment_in_domain(rules: Rules, name: str = "segment") -> Rule:
    return Rule("segment_domain", F.col(name).isin(*rules.segment_codes))


def has_time(name: str) -> Rule:
    return Rule("time_present", F.col(name).isNotNull())


def in_business_dates(df: DataFrame, rules: Rules, name: str) -> Rule:
    """Literals take the column's own type, so the bound is never re-parsed."""
    kind = df.schema[name].dataType
    low, high = (F.lit(d).cast(kind) for d in (rules.date_from, rules.date_to))
    return Rule("date_range", (F.col(name) >= low) & (F.col(name) <= high))


def keep_all(df: DataFrame, kept: list[Rule]) -> DataFrame:
    return reduce(lambda out, rule: out.filter(rule.keep), kept, df)


def ledger_counts(kept: list[Rule]) -> list[Column]:
    """Aggregates `after_0`, `after_1`, ...: rows read, rows left after each rule."""
    survives = F.lit(True)
    counts = [F.count(F.lit(1)).alias("after_0")]
    for i, rule in enumerate(kept, start=1):
        survives = survives & F.coalesce(rule.keep, F.lit(False))
        counts.append(F.count_if(survives).alias(f"after_{i}"))
    return counts


def ledger_rows(counts: DataFrame, kept: list[Rule]) -> DataFrame:
    """One row per rule from the single row of `ledger_counts`."""
    steps = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(rule.name).alias("rule"),
            F.col(f"after_{i - 1}").alias("rows_before"),
            (F.col(f"after_{i - 1}") - F.col(f"after_{i}")).alias("rows_removed"),
            F.col(f"after_{i}").alias("rows_after"),
        )
        for i, rule in enumerate(kept, start=1)
    ]
    return counts.select(F.inline(F.array(*steps)))


def ledger(df: DataFrame, kept: list[Rule]) -> DataFrame:
    """Rows before, removed by and after each rule, in one pass over `df`."""
    return ledger_rows(df.agg(*ledger_counts(kept)), kept)


def with_row_as_read(raw: DataFrame) -> DataFrame:
    """raw with each row as text: the record itself if its width was wrong, else its fields as JSON."""
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != MALFORMED]))
    record = F.coalesce(F.col(MALFORMED), fields) if MALFORMED in raw.columns else fields
    return raw.withColumn(AS_READ, record)


def rejects(typed: DataFrame, kept: list[Rule]) -> DataFrame:
    """The removed rows: the first rule that each breaks, its id, and the row as it was read.

    `typed` comes from `with_row_as_read`. Its rows are those that the ledger counts.
    """
    broken = [F.when(~F.coalesce(rule.keep, F.lit(False)), F.lit(rule.name)) for rule in kept]
    first = F.coalesce(*broken) if broken else F.lit(None).cast("string")
    found = typed.withColumn("rule", first).filter(F.col("rule").isNotNull())
    return found.select("rule", "user_id", F.col(AS_READ).alias("record"))


# --- column conversions and the three tables ---------------------------------


def type_users(raw: DataFrame) -> DataFrame:
    return drop_index(raw).withColumns(
        {"type": number(raw, "type"), "rubro": number(raw, "rubro")}
    )


def type_transactions(raw: DataFrame) -> DataFrame:
    return drop_index(raw).withColumns(
        {
            "transaction_dt": timestamp(raw, "transaction_dt"),
            "type": code(raw, "type"),
            "segment": code(raw, "segment"),
        }
    )


def type_onboarding(raw: DataFrame) -> DataFrame:
    """Flags to 0/1, date columns to timestamps, `return` to `return_flag`."""
    df = drop_index(raw)
    moments = [c for c in df.columns if c.endswith("_dt")]
    typed = df.withColumns(
        {c: flag(df, c) for c in ("habito", "activacion", "setup", "return")}
        | {c: timestamp(df, c) for c in moments}
    )
    return typed.withColumnRenamed("return", "return_flag")


def user_rules(rules: Rules) -> list[Rule]:
    return [has_prefix(rules), has_key(), key_format(rules)]


def transaction_rules(typed: DataFrame, rules: Rules) -> list[Rule]:
    return [
        has_prefix(rules),
        type_in_domain(rules),
        segment_in_domain(rules),
        has_time("transaction_dt"),
        in_business_dates(typed, rules, "transaction_dt"),
    ]


def onboarding_rules(typed: DataFrame, rules: Rules) -> list[Rule]:
    return [
        has_prefix(rules),
        has_time("first_login_dt"),
        in_business_dates(typed, rules, "first_login_dt"),
    ]


def one_line_address(users: DataFrame) -> DataFrame:
    return users.withColumn("address", collapse_whitespace(F.col("address")))


def clean_users(raw: DataFrame, rules: Rules) -> DataFrame:
    return one_line_address(keep_all(type_users(raw), user_rules(rules)))


def clean_transactions(raw: DataFrame, rules: Rules) -> DataFrame:
    typed = type_transactions(raw)
    return keep_all(typed, transaction_rules(typed, rules))


def clean_onboarding(raw: DataFrame, rules: Rules) -> DataFrame:
    typed = type_onboarding(raw)
    return keep_all(typed, onboarding_rules(typed, rules))


def prefix_only(raw: DataFrame, rules: Rules) -> DataFrame:
    """The light loader: drop the index, keep the country, check nothing else."""
    return keep_all(drop_index(raw), [has_prefix(rules)])


def users_ledger(raw: DataFrame, rules: Rules) -> DataFrame:
    return ledger(type_users(raw), user_rules(rules))


def transactions_ledger(raw: DataFrame, rules: Rules) -> DataFrame:
    typed = type_transactions(raw)
    return ledger(typed, transaction_rules(typed, rules))


def onboarding_ledger(raw: DataFrame, rules: Rules) -> DataFrame:
    typed = type_onboarding(raw)
    return ledger(typed, onboarding_rules(typed, rules))


def normalize_text(df: DataFrame, name: str) -> DataFrame:
    """Both address treatments: line breaks only, and all whitespace runs."""
    return df.withColumns(
        {
            "single_line": strip_newlines(F.col(name)),
            "normalized": collapse_whitespace(F.col(name)),
        }
    )
