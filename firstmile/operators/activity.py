"""What each user did: daily and all-time summaries, segments, the window join.

Summaries are built in two steps, user and day, then user. Both combine before
they shuffle, and the second needs no distinct count: days are rows, types are
small sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import at_midnight, in_onboarding, onboarding_end
from firstmile.rules import INDIVIDUALS, SELLERS, UNKNOWN, Rules


def _did(types: tuple[int, ...]) -> Column:
    return F.coalesce(F.bool_or(F.col("type").isin(*types)), F.lit(False))


def segment_of(paid: Column, collected: Column) -> Column:
    """Any collection makes a seller, else any payment an individual."""
    return F.when(collected, F.lit(SELLERS)).when(paid, F.lit(INDIVIDUALS)).otherwise(F.lit(UNKNOWN))


def _per_day(transactions: DataFrame, rules: Rules, *extra: Column) -> DataFrame:
    moment = F.col("transaction_dt")
    return transactions.groupBy("user_id", "transaction_date").agg(
        F.count(F.lit(1)).alias("n"),
        _did(rules.payment_types).alias("paid"),
        _did(rules.collection_types).alias("collected"),
        F.collect_set("type").alias("types"),
        F.min(moment).alias("first_dt"),
        F.max(moment).alias("last_dt"),
        *extra,
    )


def _per_user(daily: DataFrame, *extra: Column) -> DataFrame:
    return daily.groupBy("user_id").agg(
        F.sum("n").alias("total_transactions"),
        F.bool_or("paid").alias("paid"),
        F.bool_or("collected").alias("collected"),
        # A user has no more sets than days, and no more types than there are codes.
        F.size(F.array_distinct(F.flatten(F.collect_set("types")))).alias("unique_transaction_types"),
        # NULL days are not counted, as a distinct count would not.
        F.count("transaction_date").alias("transaction_days"),
        F.min("first_dt").alias("first_transaction_dt"),
        F.max("last_dt").alias("last_transaction_dt"),
        *extra,
    )


def daily_activity(
    transactions: DataFrame, rules: Rules, onboarding: DataFrame | None = None
) -> DataFrame:
    """One row per user and day: the base of both summaries and of segments.

    With `onboarding`, one row per user, also of window counts: a day inside the window
    counts whole, its last day up to midnight, and of the login's own day the rows from
    the login on are counted here, where the time of day is at hand.
    """
    dated = _dated(transactions)
    collected = F.col("type").isin(*rules.collection_types)
    counts = [
        F.count_if(F.col("type").isin(*rules.payment_types)).alias("payments"),
        F.count_if(collected).alias("collections"),
    ]
    if onboarding is not None:
        first = onboarding.select(
            "user_id", "first_login_dt", F.to_date("first_login_dt").alias("transaction_date")
        )
        dated = dated.join(first, ["user_id", "transaction_date"], "left")
        inside = in_onboarding(dated, "transaction_dt", "first_login_dt", rules.onboarding_days)
        midnight = at_midnight(dated, F.col("transaction_date"), like="transaction_dt")
        closing = F.col("transaction_dt") == midnight
        counts += [
            F.count_if(inside).alias("n_login"),
            F.count_if(inside & collected).alias("collections_login"),
            F.count_if(closing).alias("n_midnight"),
            F.count_if(closing & collected).alias("collections_midnight"),
        ]
    return _per_day(dated, rules, *counts)


def daily_summary(daily: DataFrame) -> DataFrame:
    return daily.select(
        "user_id",
        "transaction_date",
        F.col("n").alias("transaction_count"),
        F.col("payments").alias("payment_transactions"),
        F.col("collections").alias("collection_transactions"),
        F.size("types").alias("unique_transaction_types"),
    )


def user_summary(daily: DataFrame) -> DataFrame:
    """All-time counts and bounds per user."""
    return _per_user(daily).select(
        "user_id",
        "total_transactions",
        "unique_transaction_types",
        "transaction_days",
        "first_transaction_dt",
        "last_transaction_dt",
    )


def user_segments(daily: DataFrame, rules: Rules) -> DataFrame:
    """Segment and all-time summary of every user with a valid transaction."""
    users = _per_user(daily)
    return users.filter("paid OR collected").select(
        "user_id",
        segment_of(F.col("paid"), F.col("collected")).alias("user_segment"),
        "total_transactions",
        "unique_transaction_types",
        "transaction_days",
        "first_transaction_dt",
        "last_transaction_dt",
    )


def segment_only(transactions: DataFrame, rules: Rules) -> DataFrame:
    """Just (user_id, user_segment): one shuffle of one row per user and task."""
    paid, collected = _did(rules.payment_types), _did(rules.collection_types)
    return (
        transactions.groupBy("user_id")
        .agg(paid.alias("paid"), collected.alias("collected"))
        .filter("paid OR collected")
        .select("user_id", segment_of(F.col("paid"), F.col("collected")).alias("user_segment"))
    )


def family_counts(transactions: DataFrame, rules: Rules) -> DataFrame:
    """Payments, collections and other rows per user, in one aggregate."""
    kind = F.col("type")
    return transactions.groupBy("user_id").agg(
        F.count_if(kind.isin(*rules.payment_types)).alias("payments"),
        F.count_if(kind.isin(*rules.collection_types)).alias("collections"),
    )


def family_users(transactions: DataFrame, types: tuple[int, ...]) -> DataFrame:
    return transactions.filter(F.col("type").isin(*types)).select("user_id").distinct()


def family_membership(transactions: DataFrame, rules: Rules) -> DataFrame:
    """Full outer join of paying and collecting users, as 0/1 columns."""
    paying = family_users(transactions, rules.payment_types)
    collecting = family_users(transactions, rules.collection_types)
    return (
        paying.withColumn("has_payments", F.lit(1))
        .join(collecting.withColumn("has_collections", F.lit(1)), "user_id", "outer")
        .fillna(0, ["has_payments", "has_collections"])
    )


def with_segment(onboarding: DataFrame, transactions: DataFrame, rules: Rules) -> DataFrame:
    """Onboarding users with their segment; without transactions it is UNKNOWN."""
    return onboarding.join(
        segment_only(transactions, rules), "user_id", "left"
    ).fillna(UNKNOWN, ["user_segment"])


def near_windows(
    onboarding: DataFrame, transactions: DataFrame, rules: Rules
) -> DataFrame:
    """Transactions between the first login of all and the last window's end.

    The two bounds are subqueries, so at run time they prune the scan: a cohort
    of six months does not read years of transactions.
    """
    end = onboarding_end(F.col("first_login_dt"), rules.onboarding_days)
    ends = at_midnight(transactions, end, like="transaction_dt")
    first = onboarding.agg(F.min("first_login_dt")).scalar()
    last = onboarding.agg(F.max(ends)).scalar()
    moment = F.col("transaction_dt")
    return transactions.filter((moment >= first) & (moment <= last))


def _dated(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("transaction_date", F.to_date("transaction_dt"))


def _windows(onboarding: DataFrame, rules: Rules, *extra: Column) -> DataFrame:
    """First and last day of each user's window."""
    return onboarding.select(
        "user_id",
        "first_login_dt",
        F.to_date("first_login_dt").alias("first_day"),
        onboarding_end(F.col("first_login_dt"), rules.onboarding_days).alias("last_day"),
        *extra,
    )


def window_transactions(
    onboarding: DataFrame, transactions: DataFrame, rules: Rules
) -> DataFrame:
    """Transactions inside their user's onboarding window, with the first login.

    `onboarding` must hold one row per user (see dedupe). Which days of which user lie in
    a window is settled on one row a user and day; by these days transactions are then
    joined, so that no task gets more than a day of one user, however much of the data
    that user owns, and no login is repeated for days without transactions.
    """
    near = _dated(near_windows(onboarding, transactions, rules))
    active = near.select("user_id", "transaction_date").distinct()
    days = (
        active.join(_windows(onboarding, rules), "user_id")
        .filter(F.col("transaction_date").between(F.col("first_day"), F.col("last_day")))
        .select("user_id", "transaction_date", "first_login_dt")
    )
    joined = near.join(days, ["user_id", "transaction_date"])
    inside = in_onboarding(
        joined, "transaction_dt", "first_login_dt", rules.onboarding_days
    )
    return joined.filter(inside).select(*transactions.columns, "first_login_dt")


def with_daily_activity(onboarding: DataFrame, daily: DataFrame, rules: Rules) -> DataFrame:
    """Onboarding users with segment, all-time and window columns, NULL where they did nothing.

    `daily` is `daily_activity` with this onboarding table, for example as landed:
    transactions are not read. The user's own columns ride through the sums in one
    struct, so that onboarding is shuffled for one join, not for two.
    """
    day, first, last = F.col("transaction_date"), F.col("first_day"), F.col("last_day")

    def within(whole: str, login: str, midnight: str) -> Column:
        return (
            F.when(day == first, F.col(login))
            .when(day == last, F.col(midnight))
            .when((day > first) & (day < last), F.col(whole))
            .otherwise(F.lit(0))
        )

    own = onboarding.columns
    users = _windows(onboarding, rules, F.struct(*own).alias("own")).drop("first_login_dt")
    counted = users.join(daily, "user_id", "left").withColumns(
        {
            "n_in": within("n", "n_login", "n_midnight"),
            "collected_in": within("collections", "collections_login", "collections_midnight"),
        }
    )
    measured = _per_user(
        counted,
        F.sum("n_in").alias("window_transactions"),
        F.sum("collected_in").alias("window_collections"),
        F.count_if(F.col("n_in") > 0).alias("window_days"),
        F.first("own").alias("own"),
    )
    # Counts of nothing are 0 in SQL; who did nothing has none.
    active = F.col("total_transactions").isNotNull()
    found = [c for c in measured.columns if c not in ("user_id", "own")]
    return measured.select(
        *[F.col("own")[c].alias(c) for c in own],
        *[F.when(active, F.col(c)).alias(c) for c in found],
        segment_of(F.col("paid"), F.col("collected")).alias("user_segment"),
    )


def with_activity(
    onboarding: DataFrame,
    transactions: DataFrame,
    rules: Rules,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Onboarding users, one row each, with segment, all-time and window columns.

    Give `segments`, the landed table of `user_segments`, where there is one:
    it already holds the segment and the all-time columns, so transactions are
    read for the windows only.
    """
    if segments is None:
        daily = daily_activity(transactions, rules, onboarding)
        return with_daily_activity(onboarding, daily, rules)
    near = near_windows(onboarding, transactions, rules)
    daily = daily_activity(near, rules, onboarding)
    active = with_daily_activity(onboarding, daily, rules)
    window = [c for c in active.columns if c.startswith("window_")]
    return (
        active.select(*onboarding.columns, *window)
        .join(segments, "user_id", "left")
        .fillna(UNKNOWN, ["user_segment"])
    )
