"""Set questions, cleaning and funnels against plain Python."""

from collections import Counter
from datetime import datetime

from helpers import ONBOARDING, TRANSACTIONS, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from firstmile import Rules
from firstmile.operators import cleaning, experiment, funnel, metrics, overlap, quality

RULES = Rules()
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ids = st.lists(st.one_of(st.none(), st.sampled_from(["MLB1", "MLB2", "MLB3", "MLA4", "x"])), max_size=12)


def of_ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "user_id string")


@few
@given(users=ids, transactions=ids, onboarding=ids)
def test_overlaps(spark, users, transactions, onboarding):
    frames = [of_ids(spark, v) for v in (users, transactions, onboarding)]
    u, t, o = set(users), set(transactions), set(onboarding)
    got = tuple(overlap.overlap_counts(*frames).first())
    assert got == (len(u), len(t), len(o), len(u & t), len(u & o), len(t & o), len(u & t & o))
    regions = Counter((int(x in u), int(x in t), int(x in o)) for x in u | t | o)
    assert {tuple(r)[:3]: r[3] for r in overlap.membership_regions(*frames).collect()} == regions
    without = overlap.users_without_transactions(frames[2], frames[1])
    assert {r[0] for r in without.collect()} == o - t
    shares = {r["dataset"]: r for r in overlap.prefix_share({"u": frames[0]}, RULES).collect()}
    if u:
        assert shares["u"]["distinct_ids"] == len(u)
        assert shares["u"]["with_prefix"] == sum(x is not None and x.startswith("MLB") for x in u)


@few
@given(
    values=st.lists(
        st.tuples(
            st.sampled_from(["MLB1", "MLA1", None, ""]),
            st.one_of(st.none(), st.datetimes(datetime(2021, 12, 30), datetime(2023, 1, 2))),
            st.one_of(st.none(), st.integers(-1, 11)),
            st.one_of(st.none(), st.integers(0, 3)),
        ),
        max_size=30,
    )
)
def test_cleaning_and_its_ledger(spark, values):
    df = spark.createDataFrame(
        values, "user_id string, transaction_dt timestamp_ntz, type int, segment int"
    )
    checks = [
        lambda u, m, t, s: u is not None and u.startswith("MLB"),
        lambda u, m, t, s: t is not None and 1 <= t <= 9,
        lambda u, m, t, s: s in (1, 2),
        lambda u, m, t, s: m is not None,
        lambda u, m, t, s: datetime(2022, 1, 1) <= m <= datetime(2022, 12, 31),
    ]
    left, expected = values, []
    for check in checks:
        kept = [v for v in left if check(*v)]
        expected.append((len(left), len(left) - len(kept), len(kept)))
        left = kept
    assert rows(cleaning.clean_transactions(df, RULES)) == sorted(
        left, key=lambda r: tuple((v is not None, str(v)) for v in r)
    )
    ledger = cleaning.transactions_ledger(df, RULES).orderBy("step")
    got = [tuple(r) for r in ledger.select("rows_before", "rows_removed", "rows_after").collect()]
    assert got == expected


flag = st.integers(0, 1)


@few
@given(
    people=st.lists(
        st.tuples(st.datetimes(datetime(2021, 12, 20), datetime(2022, 2, 10)), flag, flag, flag, flag),
        min_size=1,
        max_size=25,
    )
)
def test_funnel_and_buckets(spark, people):
    data = [(f"MLB{i}", *p) for i, p in enumerate(people)]
    base = spark.createDataFrame(data, ONBOARDING)
    none = spark.createDataFrame([], TRANSACTIONS)
    cohorts = funnel.cohort_totals(metrics.user_flags(base, none, RULES))

    def counts(chosen):
        return tuple(
            sum(x) for x in zip(*[(1, back, act, setup, habit) for _, habit, act, setup, back in chosen])
        )

    def grouped(key):
        out = {}
        for p in people:
            out.setdefault(key(p[0]), []).append(p)
        return {k: counts(v) for k, v in out.items()}

    weeks = grouped(lambda m: "{}-W{:02d}".format(*m.isocalendar()[:2]))
    got = {r[0]: tuple(r)[2:7] for r in funnel.weekly_metrics(cohorts).collect()}
    assert got == weeks
    months = grouped(lambda m: f"{m:%Y-%m}")
    assert {r[0]: tuple(r)[2:7] for r in funnel.monthly_metrics(cohorts).collect()} == months
    table = {(r[0], r[1]): tuple(r)[3:] for r in funnel.funnel_by_dimension(cohorts, True).collect()}
    want = {("overall", "all"): counts(people), ("user_segment", "UNKNOWN"): counts(people)}
    want |= {("month", k): v for k, v in grouped(lambda m: str(m.month)).items()}
    want |= {("week", k): v for k, v in weeks.items()}
    assert table == want


@few
@given(values=st.lists(st.tuples(st.one_of(st.none(), st.floats(width=32)), st.integers(0, 2)), max_size=15))
def test_profile_and_duplicates(spark, values):
    df = spark.createDataFrame(values, "x double, k int")
    missing = sum(x is None or x != x for x, _ in values)
    got = {r["column_name"]: tuple(r)[1:4] for r in quality.quality_profile(df).collect()}
    assert got == {
        "x": (len(values), missing, len(values) - missing),
        "k": (len(values), 0, len(values)),
    }
    # NaN equals NaN and 0.0 equals -0.0 when rows are grouped.
    same = {(None if x is None else "nan" if x != x else x + 0.0, k) for x, k in values}
    total, distinct, extra = tuple(quality.duplicate_rows({"d": df}).first())[1:]
    assert (total, distinct, extra) == (len(values), len(same), len(values) - len(same))


def test_groups_are_stable_and_whole(spark):
    df = of_ids(spark, [f"MLB{i}" for i in range(1000)] + ["MLBX", None])
    groups = Counter(r["ab_group"] for r in experiment.ab_groups(df, RULES).collect())
    assert groups == {"control": 50, "treatment": 950, "unassigned": 2}
    assert experiment.outside_control(df, RULES).count() == 952


def test_groups_of_long_ids(spark):
    zeros = "0" * 39
    ids = [f"MLB{zeros}123", f"MLB{zeros}103", f"MLB{zeros}7x", "MLB" + "9" * 30 + "04", "MLB7", "MLA7", "MLB"]
    found = {r["user_id"]: r["ab_group"] for r in experiment.ab_groups(of_ids(spark, ids), RULES).collect()}
    assert list(map(found.get, ids)) == ["treatment", "control", "unassigned", "control", "treatment", "unassigned", "unassigned"]
