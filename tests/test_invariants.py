"""Relations that must hold on any input, and inputs changed without effect."""

import pytest
from conftest import SMALL
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from firstmile import Rules
from firstmile.catalog.inputs import METRIC_RULES, Inputs
from firstmile.operators import activity, funnel, metrics
from firstmile.operators.dedupe import one_row_per_user
from helpers import ONBOARDING, TRANSACTIONS, at



@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SMALL)


@pytest.fixture(scope="module")
def wide(inputs):
    return metrics.user_metrics(inputs.onboarding, inputs.transactions, METRIC_RULES)


def test_one_row_per_user(wide, inputs):
    users = inputs.onboarding_raw.select("user_id").distinct().count()
    assert wide.count() == wide.select("user_id").distinct().count() == users


def test_funnel_adds_up(wide):
    sums = (
        funnel.funnel_by_dimension(funnel.cohort_totals(wide), with_week=True)
        .drop("dimension_value")
        .groupBy("dimension_type")
        .sum()
    )
    totals = {tuple(r)[1:] for r in sums.collect()}
    assert len(totals) == 1
    total_users, registered, *_ = totals.pop()
    assert total_users == registered


def test_buckets_add_up_to_the_funnel(wide):
    cohorts = funnel.cohort_totals(wide)
    names = ["total_users", "returned_users", "activated_users", "setup_completed_users", "habit_achieved_users"]
    overall = tuple(funnel.funnel_overall(wide).drop("registered").first())
    for table in (funnel.monthly_metrics(cohorts), funnel.weekly_metrics(cohorts)):
        assert tuple(table.agg(*[F.sum(n) for n in names]).first()) == overall


def test_ledgers_chain(spark):
    for name in ("users", "transactions", "onboarding"):
        steps = sorted(entry.queries()[f"cleaning_ledger_{name}"](spark, SMALL).collect())
        for before, after in zip(steps, steps[1:]):
            assert before["rows_after"] == after["rows_before"]
        assert sum(s["rows_removed"] for s in steps) + steps[-1]["rows_after"] == steps[0]["rows_before"]


def test_repeated_registrations_change_nothing(wide, inputs):
    twice = inputs.onboarding.unionAll(inputs.onboarding).repartition(7)
    again = metrics.user_metrics(
        one_row_per_user(twice, ("first_login_dt", "seq")), inputs.transactions, METRIC_RULES
    )
    assert rows(again) == rows(wide)


def test_layout_changes_nothing(wide, inputs):
    shuffled = inputs.transactions.repartition(5, "type")
    again = metrics.user_metrics(inputs.onboarding.repartition(3), shuffled, METRIC_RULES)
    assert rows(again) == rows(wide)


def test_landed_segments_change_nothing(spark, wide, inputs, tmp_path):
    rules = METRIC_RULES
    daily = activity.daily_activity(inputs.transactions, rules)
    path = str(tmp_path / "segments")
    activity.user_segments(daily, rules).write.parquet(path)
    again = metrics.user_metrics(
        inputs.onboarding, inputs.transactions, rules, spark.read.parquet(path)
    )
    assert again.columns == wide.columns
    assert rows(again) == rows(wide)


moments = st.integers(0, 45 * 24).map(lambda h: (h // 24, h % 24))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    logins=st.dictionaries(st.sampled_from("abcd"), st.tuples(st.integers(1, 9), st.integers(0, 23)), min_size=1),
    events=st.lists(st.tuples(st.sampled_from("abcde"), moments, st.integers(1, 9)), max_size=40),
)
def test_against_plain_python(spark, logins, events):
    """Window counts by brute force."""
    from datetime import datetime, timedelta

    first = {u: datetime(2022, 1, d, h) for u, (d, h) in logins.items()}
    done = [(u, datetime(2022, 1, 1) + timedelta(days=d, hours=h), t) for u, (d, h), t in events]
    base = spark.createDataFrame([(u, m, 0, 0, 0, 0) for u, m in first.items()], ONBOARDING)
    tx = spark.createDataFrame(done, TRANSACTIONS)
    got = {
        r["user_id"]: (r["user_segment"], r["total_transactions"], r["total_transactions_period"], r["unique_transaction_days"])
        for r in metrics.user_metrics(base, tx, Rules()).collect()
    }
    want = {}
    for user, login in first.items():
        mine = [(m, t) for u, m, t in done if u == user]
        end = datetime(login.year, login.month, login.day) + timedelta(days=30)
        inside = [(m, t) for m, t in mine if login <= m <= end]
        seller = any(t in (8, 9) for _, t in mine)
        if not mine:
            want[user] = ("UNKNOWN", 0, 0, None)
        elif seller:
            want[user] = ("SELLERS", len(mine), sum(t in (8, 9) for _, t in inside), None)
        else:
            days = len({m.date() for m, _ in inside})
            want[user] = ("INDIVIDUALS", len(mine), len(inside), days or None)
    assert got == want


def test_helpers_parse_moments():
    assert at("2022-01-01 10:00:00").hour == 10
