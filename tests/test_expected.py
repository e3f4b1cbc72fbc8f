"""Published totals of the derived extracts, computed beforehand by hand-run SQL."""

from conftest import MEDIUM, SMALL
from helpers import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from firstmile.catalog.inputs import CLEANING_RULES, METRIC_RULES, Inputs
from firstmile.operators import activity, cleaning, metrics


def run(spark, name, folder=MEDIUM):
    return entry.queries()[name](spark, folder)


def test_extract_sizes(spark):
    small = {r["dataset"]: r["row_count"] for r in run(spark, "row_counts", SMALL).collect()}
    medium = {r["dataset"]: r["row_count"] for r in run(spark, "row_counts").collect()}
    assert small == {"users": 150, "transactions": 1000, "onboarding": 156}
    assert medium == {"users": 1500, "transactions": 10000, "onboarding": 1558}
    assert Inputs(spark, MEDIUM).transactions.count() == 10000


def test_cleaning_totals(spark):
    t = Inputs(spark, MEDIUM)
    assert cleaning.clean_transactions(t.transactions_raw, CLEANING_RULES).count() == 3307
    users = cleaning.clean_users(t.users_raw, CLEANING_RULES)
    nulls = users.agg(
        F.count("*"),
        F.count_if(F.col("type").isNull()),
        F.count_if(F.col("rubro").isNull()),
    )
    assert tuple(nulls.first()) == (1250, 536, 1006)


def test_segment_table(spark):
    t = Inputs(spark, MEDIUM)
    wide = metrics.user_metrics(t.onboarding, t.transactions, METRIC_RULES)
    table = wide.groupBy("user_segment").agg(
        F.count("*").alias("users"),
        F.count_if(F.col("drop_flag") == 0).alias("returned"),
        F.sum("activation_validated").alias("activated"),
        F.sum("setup_achieved").alias("setup"),
        F.sum("habit_validated").alias("flag"),
        F.sum("habit_achieved_calculated").alias("computed"),
    )
    assert rows(table) == [
        ("INDIVIDUALS", 120, 83, 60, 30, 14, 10),
        ("SELLERS", 30, 20, 15, 30, 3, 4),
        ("UNKNOWN", 1350, 935, 675, 540, 153, 0),
    ]


def test_months_and_weeks(spark):
    months = run(spark, "monthly_metrics").groupBy("year_month").agg(
        F.sum("total_users"), F.sum("returned_users"), F.sum("activated_users"),
        F.sum("setup_completed_users"), F.sum("habit_achieved_users"),
    )
    assert rows(months) == [
        ("2023-12", 516, 357, 258, 258, 56),
        ("2024-01", 984, 681, 492, 342, 114),
    ]
    weeks = run(spark, "weekly_metrics").groupBy("year_week").agg(F.sum("total_users"))
    assert rows(weeks) == [
        ("2023-W51", 215), ("2023-W52", 301), ("2024-W01", 301),
        ("2024-W02", 301), ("2024-W03", 298), ("2024-W04", 84),
    ]


def test_duplicates_would_fan_out(spark):
    """Why users are made unique first: five joins on the id multiply copies."""
    raw = Inputs(spark, MEDIUM).onboarding_raw.select("user_id")
    wide = raw
    for _ in range(4):
        wide = wide.join(raw, "user_id")
    assert wide.count() == 1442 + 58 * 32


def test_segments_need_no_window(spark):
    t = Inputs(spark, MEDIUM)
    daily = activity.daily_activity(t.transactions, METRIC_RULES)
    counts = activity.user_segments(daily, METRIC_RULES).groupBy("user_segment").count()
    assert rows(counts) == [("INDIVIDUALS", 120), ("SELLERS", 30)]
