"""The profiling report of raw extracts, as named small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from firstmile.operators import cleaning, overlap, quality
from firstmile.plans.batch import Extracts
from firstmile.rules import Rules
from firstmile.schemas import schema_listing


def explore(raw: Extracts, rules: Rules) -> dict[str, DataFrame]:
    """Every report, unevaluated: reading one runs only its own job."""
    tables = {
        "users": raw.users,
        "transactions": raw.transactions,
        "onboarding": raw.onboarding,
    }
    users = cleaning.type_users(raw.users)
    transactions = cleaning.type_transactions(raw.transactions)
    onboarding = cleaning.type_onboarding(raw.onboarding)
    overlaps = overlap.overlap_counts(users, transactions, onboarding)
    reports = {
        "row_counts": quality.row_counts(tables),
        "duplicate_rows": quality.duplicate_rows(tables),
        "invalid_counts": quality.invalid_counts(users, transactions, rules),
        "unreadable_counts": quality.unreadable_counts(tables),
        "overlap_counts": overlaps,
        "coverage_ratios": overlap.coverage_ratios(overlaps),
        "membership_regions": overlap.membership_regions(users, transactions, onboarding),
        "prefix_share": overlap.prefix_share(tables, rules),
        "segmentation_profile": overlap.segmentation_profile(onboarding, transactions, rules),
        "flag_totals": quality.flag_totals(onboarding),
        "dist_type": quality.distribution(transactions, "type"),
        "dist_segment": quality.distribution(transactions, "segment"),
        "dist_segment_type": quality.distribution(transactions, "segment", "type"),
        "date_ranges": quality.date_ranges(
            {
                "transactions": (transactions, "transaction_dt"),
                "onboarding": (onboarding, "first_login_dt"),
            }
        ),
    }
    for name, df in tables.items():
        reports[f"schema_{name}"] = schema_listing(df)
        reports[f"profile_{name}"] = quality.quality_profile(df)
        reports[f"preview_{name}"] = quality.preview(df, quality.all_columns(df))
    return reports
