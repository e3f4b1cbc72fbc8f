"""Named queries over a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstmile import schemas
from firstmile.catalog.inputs import CLEANING_RULES, METRIC_RULES, Inputs
from firstmile.operators import (
    activity,
    cleaning,
    experiment,
    funnel,
    metrics,
    ordered,
    overlap,
    quality,
    sketches,
)
from firstmile.plans import batch
from firstmile.plans.publish import publish, verify
from firstmile.sources import Layout, files, keyed_table, read_parquet, read_table, read_text_table, versioned_table, versions
from firstmile.sources.records import parse

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- cleaning ----------------------------------------------------------------


@_query
def filter_prefix(t):
    return cleaning.prefix_only(t.transactions_raw, CLEANING_RULES)


@_query
def filter_key_format(t):
    kept = [cleaning.has_key(), cleaning.key_format(CLEANING_RULES)]
    return cleaning.keep_all(t.users_raw, kept)


@_query
def filter_type_domain(t):
    return cleaning.keep_all(t.transactions_typed, [cleaning.type_in_domain(CLEANING_RULES)])


@_query
def filter_segment_domain(t):
    return cleaning.keep_all(t.transactions_typed, [cleaning.segment_in_domain(CLEANING_RULES)])


@_query
def filter_date_range(t):
    typed = t.transactions_typed
    rule = cleaning.in_business_dates(typed, CLEANING_RULES, "transaction_dt")
    return cleaning.keep_all(typed, [rule])


@_query
def clean_users(t):
    return cleaning.clean_users(t.users_raw, CLEANING_RULES)


@_query
def clean_transactions(t):
    return cleaning.clean_transactions(t.transactions_raw, CLEANING_RULES)


@_query
def clean_onboarding(t):
    return cleaning.clean_onboarding(t.onboarding_raw, CLEANING_RULES)


@_query
def normalize_text(t):
    documents = t.table("documents").select("doc_id", "text")
    return cleaning.normalize_text(documents, "text").drop("text")


@_query
def cleaning_ledger_users(t):
    return cleaning.users_ledger(t.users_raw, CLEANING_RULES)


@_query
def cleaning_ledger_transactions(t):
    return cleaning.transactions_ledger(t.transactions_raw, CLEANING_RULES)


@_query
def cleaning_ledger_onboarding(t):
    return cleaning.onboarding_ledger(t.onboarding_raw, CLEANING_RULES)


def _users_of_any_width(t):
    parsed = parse(t.user_records, ["user_id", "type", "rubro", "address"], malformed=True)
    typed = cleaning.type_users(cleaning.with_row_as_read(parsed))
    return typed, cleaning.right_width(typed) + cleaning.user_rules(CLEANING_RULES)


@_query
def wrong_width_ledger(t):
    return cleaning.ledger(*_users_of_any_width(t))


@_query
def wrong_width_records(t):
    rejects = cleaning.rejects(*_users_of_any_width(t))
    return rejects.filter(F.col("rule") == "row_width").select("user_id", "record")


@_query
def rejected_rows(t):
    """Every removed row of the three tables with the first rule that it breaks."""
    transactions, onboarding = t.transactions_raw, t.onboarding_raw
    tables = {
        "users": (cleaning.type_users, t.users_raw, lambda df: cleaning.user_rules(CLEANING_RULES)),
        "transactions": (cleaning.type_transactions, transactions, lambda df: cleaning.transaction_rules(df, CLEANING_RULES)),
        "onboarding": (cleaning.type_onboarding, onboarding, lambda df: cleaning.onboarding_rules(df, CLEANING_RULES)),
    }
    found = []
    for name, (typing, raw, rules) in tables.items():
        typed = typing(cleaning.with_row_as_read(raw))
        found.append(cleaning.rejects(typed, rules(typed)).select(F.lit(name).alias("dataset"), "rule", "user_id"))
    return found[0].unionAll(found[1]).unionAll(found[2])


# --- quality -----------------------------------------------------------------


def _raw_tables(t):
    return {
        "users": t.users_raw,
        "transactions": t.transactions_raw,
        "onboarding": t.onboarding_raw,
    }


def _clean_tables(t):
    return (
        cleaning.clean_users(t.users_raw, CLEANING_RULES),
        cleaning.clean_transactions(t.transactions_raw, CLEANING_RULES),
        cleaning.clean_onboarding(t.onboarding_raw, CLEANING_RULES),
    )


@_query
def quality_profile_events(t):
    return quality.quality_profile(t.table("events"))


@_query
def quality_profile_onboarding(t):
    return quality.quality_profile(t.onboarding_raw)


@_query
def quality_gate(t):
    return quality.quality_gate(quality.quality_profile(t.onboarding_raw), CLEANING_RULES)


@_query
def invalid_counts(t):
    return quality.invalid_counts(t.users_raw, t.transactions_typed, CLEANING_RULES)


@_query
def unreadable_counts(t):
    return quality.unreadable_counts(_raw_tables(t))


@_query
def row_counts(t):
    return quality.row_counts(_raw_tables(t))


@_query
def duplicate_rows(t):
    tables = _raw_tables(t)
    # The event id stands in for the saved index of an extract.
    tables["transactions"] = tables["transactions"].drop("event_id")
    return quality.duplicate_rows(tables)


@_query
def prefix_share(t):
    return overlap.prefix_share(_raw_tables(t), CLEANING_RULES)


@_query
def overlap_counts(t):
    return overlap.overlap_counts(*_clean_tables(t))


@_query
def coverage_ratios(t):
    return overlap.coverage_ratios(overlap.overlap_counts(*_clean_tables(t)))


@_query
def membership_regions(t):
    return overlap.membership_regions(*_raw_tables(t).values())


@_query
def flag_totals(t):
    return quality.flag_totals(t.onboarding_typed)


@_query
def date_ranges(t):
    return quality.date_ranges(
        {
            "transactions": (t.transactions_raw, "transaction_dt"),
            "onboarding": (t.onboarding_raw, "first_login_dt"),
        }
    )


@_query
def dist_type(t):
    return quality.distribution(t.transactions_raw, "type")


@_query
def dist_segment(t):
    return quality.distribution(t.transactions_raw, "segment")


@_query
def dist_segment_type(t):
    return quality.distribution(t.transactions_raw, "segment", "type")


@_query
def preview_transactions(t):
    return quality.preview(t.transactions, ["transaction_dt", "event_id"], rows=10)


# --- sets and joins ----------------------------------------------------------


@_query
def distinct_user_types(t):
    return t.transactions.select("user_id", "type").distinct()


@_query
def only_payment_users(t):
    return overlap.only_payment_users(t.transactions, METRIC_RULES)


@_query
def users_without_transactions(t):
    return overlap.users_without_transactions(t.onboarding_raw, t.transactions)


@_query
def outer_join_families(t):
    return activity.family_membership(t.transactions, METRIC_RULES)


@_query
def tx_by_family(t):
    return activity.family_counts(t.transactions, METRIC_RULES)


@_query
def union_habit_parts(t):
    return metrics.habit_parts(t.onboarding, t.transactions, METRIC_RULES)


@_query
def dedupe_onboarding(t):
    return t.onboarding


@_query
def window_transactions(t):
    return activity.window_transactions(t.onboarding, t.transactions, METRIC_RULES)


@_query
def users_with_segment(t):
    logins = t.onboarding.select("user_id", "first_login_dt")
    return activity.with_segment(logins, t.transactions, METRIC_RULES)


# --- metrics -----------------------------------------------------------------


def _daily(t):
    return activity.daily_activity(t.transactions, METRIC_RULES)


@_query
def transaction_summary_user(t):
    return activity.user_summary(_daily(t))


@_query
def user_segments(t):
    return activity.user_segments(_daily(t), METRIC_RULES)


@_query
def segment_counts(t):
    segments = activity.segment_only(t.transactions, METRIC_RULES)
    return segments.groupBy("user_segment").agg(F.count(F.lit(1)).alias("user_count"))


@_query
def segmentation_profile(t):
    return overlap.segmentation_profile(t.onboarding_raw, t.transactions, METRIC_RULES)


@_query
def onboarding_period(t):
    return metrics.onboarding_period(t.onboarding, METRIC_RULES)


@_query
def drop_metric(t):
    return metrics.drop_metric(t.onboarding)


@_query
def activation_metric(t):
    return metrics.activation_metric(t.onboarding, t.transactions)


@_query
def activation_agreement(t):
    return metrics.activation_agreement(metrics.activation_metric(t.onboarding, t.transactions))


def _habit(t):
    return metrics.habit_metric(t.onboarding, t.transactions, METRIC_RULES)


@_query
def habit_metric(t):
    return _habit(t)


@_query
def habit_agreement(t):
    return metrics.habit_agreement(_habit(t))


@_query
def habit_by_segment(t):
    return metrics.habit_by_segment(_habit(t))


@_query
def setup_metric(t):
    return metrics.setup_metric(t.onboarding)


def _user_metrics(t):
    return metrics.user_metrics(t.onboarding, t.transactions, METRIC_RULES)


def _user_flags(t):
    return metrics.user_flags(t.onboarding, t.transactions, METRIC_RULES)


@_query
def user_metrics(t):
    return _user_metrics(t)


@_query
def metric_rates(t):
    return metrics.metric_rates(_user_flags(t))


# --- aggregates --------------------------------------------------------------


def _cohorts(t):
    return funnel.cohort_totals(_user_flags(t))


@_query
def funnel_stages(t):
    return funnel.funnel_stages(_user_flags(t))


@_query
def funnel_overall(t):
    return funnel.funnel_overall(_user_flags(t))


@_query
def funnel_by_dimension(t):
    return funnel.funnel_by_dimension(_cohorts(t))


@_query
def funnel_by_week(t):
    return funnel.funnel_by_dimension(_cohorts(t), with_week=True)


@_query
def funnel_conversion(t):
    return funnel.funnel_conversion(funnel.funnel_by_dimension(_cohorts(t)))


@_query
def monthly_metrics(t):
    return funnel.monthly_metrics(_cohorts(t))


@_query
def weekly_metrics(t):
    return funnel.weekly_metrics(_cohorts(t))


# --- published tables --------------------------------------------------------


@_query
def contract_user_segments(t):
    segments = activity.user_segments(_daily(t), METRIC_RULES)
    return schemas.conform(segments, schemas.USER_SEGMENTS)


@_query
def contract_user_metrics(t):
    return schemas.conform(_user_metrics(t), schemas.USER_METRICS)


@_query
def contract_funnel_analysis(t):
    return schemas.conform(funnel.funnel_by_dimension(_cohorts(t)), schemas.FUNNEL_ANALYSIS)


@_query
def contract_monthly_metrics(t):
    return schemas.conform(funnel.monthly_metrics(_cohorts(t)), schemas.MONTHLY_METRICS)


@_query
def contract_weekly_metrics(t):
    return schemas.conform(funnel.weekly_metrics(_cohorts(t)), schemas.WEEKLY_METRICS)


@_query
def transaction_summary_daily(t):
    return schemas.conform(activity.daily_summary(_daily(t)), schemas.TRANSACTION_SUMMARY)


# --- specified extras --------------------------------------------------------


@_query
def ab_groups(t):
    return experiment.ab_groups(t.onboarding, METRIC_RULES)


@_query
def ab_metrics(t):
    return experiment.ab_metrics(_user_flags(t), METRIC_RULES)


@_query
def treatment_funnel(t):
    treated = experiment.outside_control(_user_flags(t), METRIC_RULES)
    return funnel.funnel_by_dimension(funnel.cohort_totals(treated))


@_query
def drop_from_activity(t):
    return metrics.drop_from_activity(t.onboarding, t.transactions)


@_query
def activation_in_window(t):
    return metrics.activation_in_window(t.onboarding, t.transactions, METRIC_RULES)


# --- stages in order, the experiment's answer, distinct users of any period --------


def _ordered(t):
    stages = [
        ordered.Stage("registered", "first_login_dt"),
        ordered.Stage("returned", "return_dt"),
        ordered.Stage("activated", "transaction_dt", t.transactions),
        ordered.Stage("set_up", "setup_dt"),
        ordered.Stage("habitual", "habito_dt"),
    ]
    users = activity.with_segment(t.onboarding, t.transactions, METRIC_RULES)
    reached = ordered.ordered_stages(users, stages, METRIC_RULES)
    return reached, [s.name for s in stages]


@_query
def funnel_ordered_users(t):
    reached, names = _ordered(t)
    return reached.select("user_id", "user_segment", *names)


@_query
def funnel_ordered(t):
    return ordered.ordered_funnel(*_ordered(t))


@_query
def ab_lift(t):
    return experiment.ab_lift(_user_flags(t), METRIC_RULES)


@_query
def ab_bootstrap(t):
    return experiment.ab_bootstrap(_user_flags(t), METRIC_RULES)


@_query
def active_users_monthly(t):
    """Exact users beside whether the estimate from sketches is within four standard errors."""
    daily = _daily(t)
    segments = activity.segment_only(t.transactions, METRIC_RULES)
    by = [F.trunc("transaction_date", "month").alias("month"), "user_segment"]
    estimated = sketches.distinct_users(sketches.daily_users(daily, segments), *by)
    users = daily.select("user_id", F.trunc("transaction_date", "month").alias("month")).distinct()
    exact = users.join(segments, "user_id").groupBy("month", "user_segment").agg(F.count(F.lit(1)).alias("users"))
    off = F.abs(F.col("estimated_users") - F.col("users"))
    return exact.join(estimated, ["month", "user_segment"]).select(
        "month",
        "user_segment",
        "transactions",
        "users",
        (off <= F.ceil(4 * sketches.relative_error() * F.col("users"))).alias("estimate_within_bound"),
    )


# --- files, sinks and the whole batch ------------------------------------------------


def _as_csv(df, path):
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**kept).csv(path)
    return path


@_query
def csv_users(t):
    """The users as CSV with line breaks in quotes, read back by many tasks a file."""
    path = _as_csv(t.users_raw, t.scratch("users"))
    return read_text_table(t.spark, path, schemas.RAW_USERS, multiline=True, parallel=True)


@_query
def parsing_impact(t):
    return files.parsing_impact(t.spark, _as_csv(t.users_raw, t.scratch("users")))


@_query
def fallback_segments(t):
    """A keyed store that is not there: the table goes to the fallback, and is read from it."""
    spare = versioned_table(t.scratch("user_segments"), Layout(key="user_id", buckets=2))
    absent = keyed_table("user_segments", "analytics", format="no.such.connector")
    publish(activity.user_segments(_daily(t), METRIC_RULES), schemas.USER_SEGMENTS, absent, spare)
    return read_table(t.spark, spare)


@_query
def content_check(t):
    """What a check of two published tables finds: rows, and how many things wrong."""
    found = []
    for contract, df in (
        (schemas.USER_SEGMENTS, activity.user_segments(_daily(t), METRIC_RULES)),
        (schemas.TRANSACTION_SUMMARY, activity.daily_summary(_daily(t))),
    ):
        sink = versioned_table(t.scratch(contract.name), Layout(key="user_id", buckets=2))
        result = publish(df, contract, sink)
        found.append((contract.name, result.rows, len(verify(t.spark, result, contract, sink))))
    return t.spark.createDataFrame(found, "table_name string, rows bigint, problems bigint")


@_query
def batch_monthly_metrics(t):
    """The whole batch on the derived extracts; its monthly table as served."""
    raw = batch.Extracts(t.users_raw, t.activity_raw.drop("event_id"), t.onboarding_raw.drop("seq"))
    folder = t.scratch("batch")
    problems = batch.run(raw, METRIC_RULES, folder).problems
    if problems:
        raise ValueError("; ".join(problems))
    return read_parquet(t.spark, f"{folder}/served/monthly_metrics")


# --- versioned tables ----------------------------------------------------------------


def _served(t, mode="overwrite"):
    layout = Layout("transaction_date", "user_id", 4)
    return versioned_table(t.scratch("transaction_summary"), layout, mode)


@_query
def versioned_daily(t):
    """Published twice; what is read is the second version."""
    daily, sink = transaction_summary_daily(t), _served(t)
    publish(daily.limit(10), schemas.TRANSACTION_SUMMARY, sink)
    publish(daily, schemas.TRANSACTION_SUMMARY, sink)
    return read_table(t.spark, sink)


@_query
def upserted_daily(t):
    """Published in three portions that overlap; the later one's rows stay."""
    daily, sink = transaction_summary_daily(t), _served(t, "append")
    for since, until in (("2000-01-01", "2024-01-14"), ("2024-01-08", "2024-02-01"), ("2024-02-02", "2100-01-01")):
        part = daily.filter(F.col("transaction_date").between(F.lit(since).cast("date"), F.lit(until).cast("date")))
        stale = F.lit(since).cast("date") == F.lit("2000-01-01").cast("date")
        wrong = F.when(stale & (F.col("transaction_date") >= F.lit("2024-01-08").cast("date")), F.lit(-1))
        part = part.withColumn("transaction_count", F.coalesce(wrong, F.col("transaction_count")))
        publish(part, schemas.TRANSACTION_SUMMARY, sink)
    return read_table(t.spark, sink)


@_query
def lookup_user_month(t):
    """Some days of one user, read from the files of the user's bucket and month."""
    sink = _served(t)
    publish(transaction_summary_daily(t), schemas.TRANSACTION_SUMMARY, sink)
    return versions.lookup(t.spark, sink.options["path"], "MLB5", date(2024, 1, 5), date(2024, 1, 31))
