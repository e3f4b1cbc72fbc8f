"""Window bounds, dirty values and calendar edges, row by row."""

from datetime import date

import pytest
from helpers import ONBOARDING, TRANSACTIONS, at, by_user, rows
from pyspark.sql import functions as F

from firstmile import Rules
from firstmile.functions import collapse_whitespace, iso_week_label, iso_year, rounded_percent
from firstmile.operators import activity, cleaning, funnel, metrics, quality
from firstmile.operators.dedupe import one_row_per_user

RULES = Rules()
LOGIN = at("2022-01-10 10:00:00")


def transactions(spark):
    def of(user, *moments):
        return [(user, at(f"2022-{m}"), t) for m, t in moments]

    data = (
        of("i1", ("01-10 09:59:59", 1), ("01-10 10:00:00", 1), ("01-11 08:00:00", 2),
           ("01-12 08:00:00", 3), ("01-13 08:00:00", 4), ("02-09 00:00:00", 5),
           ("02-09 00:00:01", 5))
        + of("i2", *[(f"01-11 0{h}:00:00", 1) for h in range(1, 7)])
        + of("s1", *[(f"01-11 0{h}:00:00", 8) for h in range(1, 6)])
        + of("s2", *[(f"01-{d} 01:00:00", 1) for d in range(11, 17)], ("03-20 01:00:00", 9))
        + of("s3", ("01-11 01:00:00", 8), ("01-12 01:00:00", 8), ("01-13 01:00:00", 9))
    )
    return spark.createDataFrame(data, TRANSACTIONS)


def onboarding(spark):
    flags = {"i1": 0, "i2": 1, "s1": 0, "s2": 1, "s3": 0, "u1": 1}
    data = [(u, LOGIN, h, 0, 0, 1) for u, h in flags.items()]
    return spark.createDataFrame(data + [data[4]], ONBOARDING)


@pytest.fixture
def rules():
    return RULES


def test_habit_window(spark, rules):
    base = one_row_per_user(onboarding(spark))
    wide = by_user(metrics.user_metrics(base, transactions(spark), rules))
    got = {
        u: (
            r["user_segment"],
            r["total_transactions"],
            r["transaction_days"],
            r["total_transactions_period"],
            r["unique_transaction_days"],
            r["habit_achieved_calculated"],
            r["habit_validated"],
        )
        for u, r in wide.items()
    }
    assert got == {
        "i1": ("INDIVIDUALS", 7, 5, 5, 5, 1, 0),
        "i2": ("INDIVIDUALS", 6, 1, 6, 1, 0, 1),
        "s1": ("SELLERS", 5, 1, 5, None, 1, 0),
        "s2": ("SELLERS", 7, 7, 0, None, 0, 1),
        "s3": ("SELLERS", 3, 3, 3, None, 0, 0),
        "u1": ("UNKNOWN", 0, 0, 0, None, 0, 1),
    }
    assert wide["i1"]["onboarding_end_dt"] == date(2022, 2, 9)


def test_window_rows(spark, rules):
    base = one_row_per_user(onboarding(spark))
    inside = activity.window_transactions(base, transactions(spark), rules)
    per_user = inside.groupBy("user_id").count()
    assert rows(per_user) == [("i1", 5), ("i2", 6), ("s1", 5), ("s2", 6), ("s3", 3)]


def test_habit_parts(spark, rules):
    base = one_row_per_user(onboarding(spark))
    parts = metrics.habit_parts(base, transactions(spark), rules)
    assert rows(
        parts,
        "user_id",
        "total_transactions_period",
        "unique_transaction_days",
        "total_collection_transactions",
    ) == [("i1", 5, 5, None), ("i2", 6, 1, None), ("s1", 5, None, 5), ("s3", 3, None, 3)]


def test_zoned_timestamps_work_too(spark):
    """Columns of the zoned type give the same counts as wall-clock ones."""
    zoned = transactions(spark).withColumn("transaction_dt", F.col("transaction_dt").cast("timestamp"))
    base = one_row_per_user(onboarding(spark)).withColumn(
        "first_login_dt", F.col("first_login_dt").cast("timestamp")
    )
    wide = by_user(metrics.user_metrics(base, zoned, RULES))
    assert wide["i1"]["total_transactions_period"] == 5
    assert wide["i1"]["unique_transaction_days"] == 5


def test_any_type_code_is_counted(spark):
    """Codes are no bits: large, negative and missing ones neither fail nor collide."""
    data = [("MLB1", LOGIN, t) for t in (3, 99, -1, 63, 127, 99, None)] + [("MLB2", LOGIN, 1000)]
    tx = spark.createDataFrame(data, TRANSACTIONS)
    assert rows(activity.segment_only(tx, RULES)) == [("MLB1", "INDIVIDUALS")]
    daily = activity.daily_activity(tx, RULES)
    assert {r[0]: r["unique_transaction_types"] for r in activity.daily_summary(daily).collect()} == {"MLB1": 5, "MLB2": 1}
    assert {r[0]: r["unique_transaction_types"] for r in activity.user_summary(daily).collect()} == {"MLB1": 5, "MLB2": 1}
    wide = Rules(payment_types=(1, 70), collection_types=(900,))
    assert rows(activity.segment_only(spark.createDataFrame([("MLB1", LOGIN, 70), ("MLB2", LOGIN, 900)], TRANSACTIONS), wide)) == [
        ("MLB1", "INDIVIDUALS"), ("MLB2", "SELLERS"),
    ]



def test_rules_reject_unusable_values():
    with pytest.raises(ValueError):
        Rules(payment_types=(1, 8))
    with pytest.raises(ValueError):
        Rules(habit={})
    with pytest.raises(ValueError):
        Rules(date_from="2022-13-01")
    with pytest.raises(ValueError):
        Rules(date_from="2023-01-01")
    with pytest.raises(ValueError):
        Rules(control_percent=101)


def users(spark, *values):
    return spark.createDataFrame(values, "user_id string, type string, rubro string, address string")


def test_user_ids(spark):
    ids = ["MLB1", "MLB", "MLBX1", "MLA1", "mlb1", "", None]
    raw = users(spark, *[(i, "1.0", None, "a") for i in ids])
    assert rows(cleaning.clean_users(raw, RULES), "user_id") == [("MLB1",)]
    ledger = rows(cleaning.users_ledger(raw, RULES))
    assert ledger == [(1, "id_prefix", 7, 4, 3), (2, "id_present", 3, 0, 3), (3, "id_format", 3, 2, 1)]


def test_dirty_numbers_and_addresses(spark):
    values = ["1.0", "abc", "", " ", None]
    raw = users(spark, *[(f"MLB{i}", v, v, "a, 1\nb\nc  d") for i, v in enumerate(values)])
    got = rows(cleaning.clean_users(raw, RULES), "user_id", "type", "rubro", "address")
    text = "a, 1 b c d"
    assert got == [("MLB0", 1.0, 1.0, text)] + [(f"MLB{i}", None, None, text) for i in range(1, 5)]


def test_text_treatments(spark):
    df = spark.createDataFrame([("a\n\n b\t c",), (None,)], "text string")
    got = rows(cleaning.normalize_text(df, "text"), "single_line", "normalized")
    assert got == [(None, None), ("a   b\t c", "a b c")]
    assert rows(df.select(collapse_whitespace(F.col("text")))) == [(None,), ("a b c",)]


def test_transaction_codes_from_text(spark):
    raw = spark.createDataFrame(
        [("MLB1", "2022-05-01 10:00:00", t, "1") for t in ["1", "3.0", "9", "1.5", "0", "10", "x", "", None]],
        "user_id string, transaction_dt string, type string, segment string",
    )
    clean = cleaning.clean_transactions(raw, RULES)
    assert rows(clean, "type") == [(1,), (3,), (9,)]
    assert dict(clean.dtypes)["transaction_dt"] == "timestamp_ntz"


@pytest.mark.parametrize(
    "kind, kept",
    [
        ("timestamp_ntz", ["2022-01-01 00:00:00", "2022-12-31 00:00:00"]),
        ("timestamp", ["2022-01-01 00:00:00", "2022-12-31 00:00:00"]),
        ("date", ["2022-01-01 00:00:00", "2022-12-31 00:00:00", "2022-12-31 00:00:01"]),
    ],
)
def test_business_dates(spark, kind, kept):
    """Midnight of the last day is in; later that day only for plain dates."""
    moments = ["2021-12-31 23:59:59", "2022-01-01 00:00:00", "2022-12-31 00:00:00", "2022-12-31 00:00:01"]
    df = spark.createDataFrame([(m,) for m in moments], "m string").withColumn("t", F.col("m").cast(kind))
    rule = cleaning.in_business_dates(df, RULES, "t")
    assert [r[0] for r in rows(cleaning.keep_all(df, [rule]), "m")] == kept


def test_flags(spark):
    raw = spark.createDataFrame(
        [("MLB1", "2022-02-01", None, "1.0", "0", ""), ("MLB2", "2022-02-01", "0.0", "1", "2", None)],
        "user_id string, first_login_dt string, habito string, activacion string,"
        " setup string, `return` string",
    )
    got = rows(
        cleaning.clean_onboarding(raw, RULES), "user_id", "habito", "activacion", "setup", "return_flag"
    )
    assert got == [("MLB1", 0, 1, 0, 0), ("MLB2", 0, 1, 0, 0)]


def test_numeric_flags_with_nan(spark):
    raw = spark.createDataFrame(
        [("MLB1", LOGIN, float("nan"), 1, 1, 1), ("MLB2", LOGIN, 1.0, None, 0, 0)],
        "user_id string, first_login_dt timestamp_ntz, habito double, activacion int,"
        " setup int, `return` int",
    )
    got = rows(cleaning.clean_onboarding(raw, RULES), "user_id", "habito", "activacion")
    assert got == [("MLB1", 0, 1), ("MLB2", 1, 0)]


def test_counts_of_odd_flags_agree(spark):
    """Only 1 is a flag: sums, conditional counts and groups see the same users."""
    raw = spark.createDataFrame(
        [(f"MLB{i}", LOGIN, h, 1, 0, 1) for i, h in enumerate([1.0, 2.0, -1.0, float("nan"), 0.5, None])],
        "user_id string, first_login_dt timestamp_ntz, habito double, activacion int, setup int, `return` int",
    )
    clean = cleaning.clean_onboarding(raw, RULES)
    assert clean.agg(F.sum("habito"), F.count_if(F.col("habito") == 1)).first() == (1, 1)


def test_unreadable_values_are_counted(spark):
    """The dirtiest values become NULL when typed; the report counts them before."""
    text = spark.createDataFrame(
        [("MLB1", "x", "1", "soon"), ("MLB2", " ", "zz", "2022-01-01 10:00:00"), ("MLB3", "12", None, None), ("MLB4", "3.5", "2", "")],
        "user_id string, type string, segment string, transaction_dt string",
    )
    assert rows(quality.unreadable_counts({"t": text})) == [("t", "segment", 1), ("t", "transaction_dt", 2), ("t", "type", 3)]


def test_drop_values(spark):
    df = spark.createDataFrame(
        [(f"MLB{i}", LOGIN, 0, 0, 0, r) for i, r in enumerate([1, 0, 2, None])], ONBOARDING
    )
    assert rows(metrics.drop_metric(df), "user_id", "drop_flag") == [
        ("MLB0", 0), ("MLB1", 1), ("MLB2", 1), ("MLB3", 1),
    ]


def test_iso_weeks(spark):
    days = ["2022-01-01", "2022-01-03", "2022-12-31"]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("day", F.to_date("d"))
    label = iso_week_label(iso_year(F.col("day")), F.weekofyear("day"))
    assert rows(df.select("d", label)) == [
        ("2022-01-01", "2021-W52"), ("2022-01-03", "2022-W01"), ("2022-12-31", "2022-W52"),
    ]


def test_empty_input(spark):
    none = spark.createDataFrame([], ONBOARDING)
    wide = metrics.user_metrics(none, transactions(spark), RULES)
    assert wide.count() == 0
    cohorts = funnel.cohort_totals(wide)
    for table in (
        funnel.monthly_metrics(cohorts),
        funnel.weekly_metrics(cohorts),
        funnel.funnel_by_dimension(cohorts),
    ):
        assert table.count() == 0
    assert rows(metrics.metric_rates(wide), "hits", "rate") == [(0, None)] * 4


def test_no_transactions_at_all(spark):
    none = spark.createDataFrame([], TRANSACTIONS)
    wide = metrics.user_metrics(one_row_per_user(onboarding(spark)), none, RULES)
    assert {r["user_segment"] for r in wide.collect()} == {"UNKNOWN"}
    assert wide.filter("habit_achieved_calculated <> 0").count() == 0


def test_percentages(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 0)], "a int, b int")
    assert rows(df.select(rounded_percent(F.col("a"), F.col("b")))) == [(None,), (None,), (33.33,)]


def test_dedupe_is_deterministic(spark):
    data = [
        ("a", at("2022-01-02 00:00:00"), 1, 1, 1, 1),
        ("a", at("2022-01-01 00:00:00"), 1, 0, 0, 0),
        ("a", at("2022-01-01 00:00:00"), 0, 1, 1, 1),
        ("b", at("2022-01-05 00:00:00"), None, 1, 1, 1),
    ]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, ONBOARDING).repartition(3)
        assert rows(one_row_per_user(df)) == [
            ("a", at("2022-01-01 00:00:00"), 0, 1, 1, 1),
            ("b", at("2022-01-05 00:00:00"), None, 1, 1, 1),
        ]
