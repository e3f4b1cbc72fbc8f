"""The batch: preprocess, transform, serve, with a Parquet table between stages.

Each stage reads what the one before wrote, so a stage can be run alone and a
failure never reaches further back than the last table written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstmile import schemas
from firstmile.operators import activity, cleaning, funnel, metrics, overlap
from firstmile.operators.dedupe import one_row_per_user
from firstmile.plans.publish import WRITTEN, Published, publish, verify
from firstmile.rules import Rules
from firstmile.schemas import Contract
from firstmile.sources import Layout, read_parquet, read_text_table, versioned_table, versions, write_parquet
from firstmile.sources.keyed import VERSIONED, Sink

#: Rows of a served table in one bucket: what one task sorts and writes.
ROWS_PER_BUCKET = 2_000_000

LEDGER_SCHEMA = (
    "dataset string, step int, rule string,"
    " rows_before bigint, rows_removed bigint, rows_after bigint"
)


@dataclass(frozen=True)
class Extracts:
    """The three tables, raw or clean."""

    users: DataFrame
    transactions: DataFrame
    onboarding: DataFrame


def read_extracts(
    spark: SparkSession,
    users: str,
    transactions: str,
    onboarding: str,
    parallel: bool = False,
    malformed: bool = False,
) -> Extracts:
    """CSV extracts. Only the users file has line breaks inside a field: with `parallel`
    many tasks read it all the same. With `malformed`, records of another width are kept
    apart, for the ledger and the reject table."""
    return Extracts(
        read_text_table(spark, users, schemas.RAW_USERS, True, parallel, malformed),
        read_text_table(spark, transactions, schemas.RAW_TRANSACTIONS, malformed=malformed),
        read_text_table(spark, onboarding, schemas.RAW_ONBOARDING, malformed=malformed),
    )


def land_raw(raw: Extracts, folder: str) -> Extracts:
    """The extracts as Parquet, unchanged: for when several jobs read them.

    Profiling makes many passes over few columns, and a CSV file with line
    breaks in its fields is read whole by one task each time.
    """
    spark = raw.users.sparkSession
    landed = []
    for name, df in (
        ("users", raw.users),
        ("transactions", raw.transactions),
        ("onboarding", raw.onboarding),
    ):
        write_parquet(df, f"{folder}/raw_{name}")
        landed.append(read_parquet(spark, f"{folder}/raw_{name}", df.schema))
    return Extracts(*landed)


def _land(
    typed: DataFrame,
    kept: list[cleaning.Rule],
    path: str,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> list[int]:
    """Write the surviving rows and return the rows left after each rule.

    The counts are observed on the rows that the write reads anyway. The job
    has no shuffle, so a retried task cannot be counted twice.
    """
    seen = Observation()
    watched = typed.observe(seen, *cleaning.ledger_counts(kept))
    write_parquet(finish(cleaning.keep_all(watched, kept)), path)
    counts = seen.get
    return [counts[f"after_{i}"] for i in range(len(kept) + 1)]


def preprocess(raw: Extracts, rules: Rules, folder: str, rejects: bool = False) -> DataFrame:
    """Clean and land the three tables; returns the ledger of all their rules.

    With `rejects`, the removed rows go to `folder`/rejects, each with its table, the
    first rule that it broke, and what was read. That reads the extracts once more.
    """
    as_read = cleaning.with_row_as_read if rejects else (lambda df: df)
    users = cleaning.type_users(as_read(raw.users))
    transactions = cleaning.type_transactions(as_read(raw.transactions))
    onboarding = cleaning.type_onboarding(as_read(raw.onboarding))
    plans = {
        "users": (
            users,
            cleaning.user_rules(rules),
            lambda df: schemas.declared(cleaning.one_line_address(df), schemas.CLEAN_USERS, "users"),
        ),
        "transactions": (
            transactions,
            cleaning.transaction_rules(transactions, rules),
            lambda df: schemas.declared(df, schemas.CLEAN_TRANSACTIONS, "transactions"),
        ),
        "onboarding": (
            onboarding,
            cleaning.onboarding_rules(onboarding, rules),
            lambda df: schemas.declared(df, schemas.CLEAN_ONBOARDING, "onboarding"),
        ),
    }
    rows, removed = [], []
    for name, (typed, own, finish) in plans.items():
        kept = cleaning.right_width(typed) + own
        removed.append(cleaning.rejects(typed, kept).select(F.lit(name).alias("dataset"), "*") if rejects else None)
        left = _land(typed, kept, f"{folder}/clean_{name}", finish)
        for i, rule in enumerate(kept, start=1):
            rows.append((name, i, rule.name, left[i - 1], left[i - 1] - left[i], left[i]))
    if rejects:
        write_parquet(removed[0].unionAll(removed[1]).unionAll(removed[2]), f"{folder}/rejects")
    return raw.users.sparkSession.createDataFrame(rows, LEDGER_SCHEMA)


def read_clean(spark: SparkSession, folder: str) -> Extracts:
    expected = {
        "users": schemas.CLEAN_USERS,
        "transactions": schemas.CLEAN_TRANSACTIONS,
        "onboarding": schemas.CLEAN_ONBOARDING,
    }
    return Extracts(
        *[read_parquet(spark, f"{folder}/clean_{n}", schema) for n, schema in expected.items()]
    )


def consistency(clean: Extracts, folder: str) -> DataFrame:
    """Land and return how far the users of the clean tables overlap."""
    counts = overlap.overlap_counts(clean.users, clean.transactions, clean.onboarding)
    write_parquet(counts, f"{folder}/consistency")
    return read_parquet(clean.users.sparkSession, f"{folder}/consistency")


def transform(clean: Extracts, rules: Rules, folder: str) -> None:
    """Land daily activity, the user segments built on it, and user metrics.

    Transactions are read and shuffled once, for daily activity; all else is its roll-up.
    """
    spark = clean.users.sparkSession
    write_parquet(one_row_per_user(clean.onboarding), f"{folder}/onboarding_users")
    onboarding = read_parquet(spark, f"{folder}/onboarding_users")
    write_parquet(
        activity.daily_activity(clean.transactions, rules, onboarding), f"{folder}/daily_activity"
    )
    daily = read_parquet(spark, f"{folder}/daily_activity")
    write_parquet(activity.user_segments(daily, rules), f"{folder}/user_segments")
    write_parquet(
        metrics.user_metrics_from_daily(onboarding, daily, rules), f"{folder}/user_metrics"
    )


def _fallback(folder: str, table: str) -> Sink:
    return versioned_table(f"{folder}/fallback/{table}")


def layout_of(contract: Contract, rows: int) -> Layout:
    """Folders for a served table: months where its key has a day, buckets of its first
    key column so that one holds ROWS_PER_BUCKET rows or so of the whole table."""
    days = [k for k in contract.key if isinstance(contract.schema[k].dataType, T.DateType)]
    return Layout(days[0] if days else None, contract.key[0], max(1, -(-rows // ROWS_PER_BUCKET)))


def serve(
    spark: SparkSession,
    folder: str,
    sink_of: Callable[[str], Sink],
    with_week: bool = False,
    adapt: Callable[[Contract], Contract] = lambda contract: contract,
) -> list[Published]:
    """Publish the six tables; a failing sink falls back to Parquet under `folder`.

    `adapt` changes contracts to what the store takes: `Contract.with_instants`,
    `Contract.with_wide_counts`.
    """
    wide = read_parquet(spark, f"{folder}/user_metrics")
    write_parquet(funnel.cohort_totals(wide), f"{folder}/cohorts")
    cohorts = read_parquet(spark, f"{folder}/cohorts")
    daily = read_parquet(spark, f"{folder}/daily_activity")
    tables = [
        (schemas.USER_SEGMENTS, read_parquet(spark, f"{folder}/user_segments"), "user_segments"),
        (schemas.USER_METRICS, wide, "user_metrics"),
        (schemas.FUNNEL_ANALYSIS, funnel.funnel_by_dimension(cohorts, with_week), None),
        (schemas.MONTHLY_METRICS, funnel.monthly_metrics(cohorts), None),
        (schemas.WEEKLY_METRICS, funnel.weekly_metrics(cohorts), None),
        (schemas.TRANSACTION_SUMMARY, activity.daily_summary(daily), "daily_activity"),
    ]
    published = []
    for contract, df, source in tables:
        # Its source's commit knows the rows; roll-ups of cohorts are small.
        rows = versions.current(spark, f"{folder}/{source}").rows if source else 0
        sinks = sink_of(contract.name), _fallback(folder, contract.name)
        sink, spare = (_laid_out(s, layout_of(contract, rows)) for s in sinks)
        published.append(publish(df, adapt(contract), sink, spare))
    return published


def _laid_out(sink: Sink, layout: Layout) -> Sink:
    """A versioned sink without a layout of its own gets this one."""
    return replace(sink, layout=layout) if sink.format == VERSIONED and not sink.layout.columns() else sink


def check(
    spark: SparkSession,
    folder: str,
    published: list[Published],
    sink_of: Callable[[str], Sink],
    adapt: Callable[[Contract], Contract] = lambda contract: contract,
) -> list[str]:
    """Read every served table back from where it went; what is wrong with any."""
    problems = []
    for result in published:
        name = result.table
        sink = sink_of(name) if result.status == WRITTEN else _fallback(folder, name)
        problems += verify(spark, result, adapt(schemas.CONTRACTS[name]), sink)
    return problems


class Outcome(NamedTuple):
    """What `run` did: the cleaning ledger, what became of each served table, what is wrong with any."""

    ledger: DataFrame
    published: list[Published]
    problems: list[str]


def clean_and_compare(
    raw: Extracts, rules: Rules, folder: str, rejects: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Land the clean tables, their overlaps and coverage; return ledger and overlaps."""
    ledger = preprocess(raw, rules, folder, rejects)
    overlaps = consistency(read_clean(raw.users.sparkSession, folder), folder)
    write_parquet(overlap.coverage_ratios(overlaps), f"{folder}/coverage")
    return ledger, overlaps


def serve_and_check(
    spark: SparkSession,
    folder: str,
    sink_of: Callable[[str], Sink] | None = None,
    with_week: bool = False,
    adapt: Callable[[Contract], Contract] = lambda contract: contract,
) -> tuple[list[Published], list[str]]:
    """Publish the six tables and read each of them back."""
    served = sink_of or (lambda name: versioned_table(f"{folder}/served/{name}"))
    published = serve(spark, folder, served, with_week, adapt)
    return published, check(spark, folder, published, served, adapt)


def run(
    raw: Extracts,
    rules: Rules,
    folder: str,
    sink_of: Callable[[str], Sink] | None = None,
    with_week: bool = False,
    adapt: Callable[[Contract], Contract] = lambda contract: contract,
) -> Outcome:
    """All stages, in the order and with the checks of the command line.

    The overlaps of the clean tables are in `folder`/consistency, the coverage
    ratios in `folder`/coverage.
    """
    spark = raw.users.sparkSession
    ledger, _ = clean_and_compare(raw, rules, folder)
    transform(read_clean(spark, folder), rules, folder)
    return Outcome(ledger, *serve_and_check(spark, folder, sink_of, with_week, adapt))
