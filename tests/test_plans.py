"""Shape of the physical plans that matter at scale."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry
from firstmile.catalog import queries
from firstmile.catalog.inputs import CLEANING_RULES, METRIC_RULES, Inputs
from firstmile.operators import cleaning, funnel, metrics


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """Plan as for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert bad not in plan


def test_transactions_are_read_and_shuffled_once(spark, no_small_tables):
    t = Inputs(spark, SMALL)
    df = metrics.user_metrics(t.onboarding, t.transactions, METRIC_RULES)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("events.parquet") == 1
    # Transactions, login days, and their sums by user; onboarding for its dedupe, read twice at most.
    assert 4 <= final.count("ShuffleQueryStage") <= 5
    assert "Expand" not in final


def test_nothing_is_broadcast_by_hint(spark, no_small_tables):
    t = Inputs(spark, SMALL)
    df = metrics.user_metrics(t.onboarding, t.transactions, METRIC_RULES)
    hinted = [line for line in optimized(df).splitlines() if "strategy=broadcast" in line]
    assert not hinted


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    """Typed Parquet extracts: the rules are pushed, the unread column is not."""
    t = Inputs(spark, SMALL)
    path = str(tmp_path / "tx")
    t.transactions_raw.write.parquet(path)
    raw = spark.read.parquet(path)
    clean = cleaning.clean_transactions(raw, CLEANING_RULES).select("user_id", "type")
    plan = plan_of(clean)
    for pushed in ("StringStartsWith(user_id,MLB)", "In(type", "In(segment", "GreaterThanOrEqual(transaction_dt"):
        assert pushed in plan
    assert "event_id" not in plan.split("ReadSchema")[1]


def test_cleaning_does_not_shuffle(spark):
    """What makes counts observed during the write exact under retries."""
    for name in ("clean_users", "clean_transactions", "clean_onboarding"):
        assert "Exchange" not in plan_of(entry.queries()[name](spark, SMALL))


def test_served_tables_roll_up_cohorts(spark):
    """Grouping sets expand the small cohort table, not the users."""
    t = Inputs(spark, SMALL)
    wide = metrics.user_metrics(t.onboarding, t.transactions, METRIC_RULES)
    lines = optimized(funnel.funnel_by_dimension(funnel.cohort_totals(wide))).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("Aggregate [user_segment" in line for line in lines[expand:])


def test_rates_do_not_read_transactions(spark):
    """A left join whose columns nobody uses is dropped, scan included."""
    for name in ("metric_rates", "funnel_overall", "ab_metrics"):
        assert "events.parquet" not in plan_of(entry.queries()[name](spark, SMALL))


def test_segments_for_funnels_are_combined_before_the_shuffle(spark, no_small_tables):
    plan = plan_of(entry.queries()["weekly_metrics"](spark, SMALL))
    assert "partial_bool_or" in plan or "partial_max" in plan
    assert "transaction_dt" not in plan


def test_window_bounds_prune_the_scan(spark):
    plan = plan_of(entry.queries()["window_transactions"](spark, SMALL))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events" in line]
    assert scans
    assert all("DataFilters" in s and "Subquery" in s for s in scans)


def test_set_differences_shuffle_once(spark, no_small_tables):
    for name in ("only_payment_users", "users_without_transactions", "overlap_counts"):
        plan = plan_of(entry.queries()[name](spark, SMALL))
        assert plan.count("Exchange hashpartitioning") == 1
