"""Drop, activation, habit and setup, and the wide table that holds all four.

The published value of a metric is the flag of the onboarding extract. Where
transactions allow it, the value is also computed, and `*_agrees` says whether
the two match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import onboarding_end, percent, rounded_percent
from firstmile.operators.activity import near_windows, with_activity, with_daily_activity, with_segment
from firstmile.rules import Rules

# Carried into the wide table when the onboarding extract has them.
PASS_THROUGH = ("week_year", "return_dt", "activacion_dt", "setup_dt")


def _as_int(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _present(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def drop_flag() -> Column:
    return F.when(F.col("return_flag") == 1, F.lit(0)).otherwise(F.lit(1))


def drop_metric(onboarding: DataFrame) -> DataFrame:
    kept = _present(onboarding, "user_id", "first_login_dt", "return_flag", "return_dt")
    return onboarding.select(*kept, drop_flag().alias("drop_flag"))


def setup_metric(onboarding: DataFrame) -> DataFrame:
    kept = _present(onboarding, "user_id", "first_login_dt", "setup", "setup_dt")
    return onboarding.select(*kept, F.col("setup").alias("setup_achieved"))


def activation_metric(onboarding: DataFrame, transactions: DataFrame) -> DataFrame:
    """Activation flag next to whether the user has any transaction at all."""
    kept = _present(onboarding, "user_id", "first_login_dt", "activacion", "activacion_dt")
    active = transactions.select("user_id").distinct()
    joined = onboarding.select(*kept).join(
        active.withColumn("has_transactions", F.lit(1)), "user_id", "left"
    )
    return joined.fillna(0, ["has_transactions"]).select(
        "*",
        F.col("activacion").alias("activation_validated"),
        _as_int(F.col("activacion") == F.col("has_transactions")).alias("activation_agrees"),
    )


def activation_agreement(activation: DataFrame) -> DataFrame:
    """How often flag and transactions say the same, per combination."""
    return activation.groupBy("activacion", "has_transactions").agg(
        F.count(F.lit(1)).alias("users"),
        F.max("activation_agrees").alias("agrees"),
    )


def _by_segment(rules: Rules, value) -> Column:
    """CASE user_segment, one branch per habit rule."""
    chosen = None
    for name, rule in rules.habit.items():
        is_segment = F.col("user_segment") == name
        branch = value(rule)
        chosen = F.when(is_segment, branch) if chosen is None else chosen.when(is_segment, branch)
    return chosen


def _period_total(rules: Rules) -> Column:
    total = _by_segment(
        rules,
        lambda rule: F.col("window_collections" if rule.collections_only else "window_transactions"),
    )
    return F.coalesce(total, F.lit(0))


def _period_days(rules: Rules) -> Column:
    """Distinct days, only where the segment's rule counts days and has any."""
    none = F.lit(None).cast("bigint")
    days = F.when(F.col("window_days") > 0, F.col("window_days"))
    return _by_segment(rules, lambda rule: none if rule.min_days is None else days)


def _habit_reached(rules: Rules) -> Column:
    def reached(rule):
        enough = F.col("total_transactions_period") >= rule.min_transactions
        if rule.min_days is not None:
            enough = enough & (F.col("window_days") >= rule.min_days)
        return _as_int(enough)

    return F.coalesce(_by_segment(rules, reached), F.lit(0))


def _with_habit(active: DataFrame, rules: Rules) -> DataFrame:
    counted = active.withColumns(
        {
            "total_transactions_period": _period_total(rules),
            "unique_transaction_days": _period_days(rules),
        }
    )
    return counted.withColumn("habit_achieved_calculated", _habit_reached(rules))


def habit_metric(
    onboarding: DataFrame,
    transactions: DataFrame,
    rules: Rules,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Habit flag and computed habit of every onboarding user."""
    active = _with_habit(with_activity(onboarding, transactions, rules, segments), rules)
    return active.select(
        "user_id",
        "user_segment",
        "first_login_dt",
        "habito",
        "total_transactions_period",
        "unique_transaction_days",
        "habit_achieved_calculated",
        F.col("habito").alias("habit_validated"),
        _as_int(F.col("habito") == F.col("habit_achieved_calculated")).alias("habit_agrees"),
    )


def habit_agreement(habit: DataFrame) -> DataFrame:
    return habit.groupBy("user_segment", "habito", "habit_achieved_calculated").agg(
        F.count(F.lit(1)).alias("users"),
        F.max("habit_agrees").alias("agrees"),
    )


def habit_by_segment(habit: DataFrame) -> DataFrame:
    return (
        habit.groupBy("user_segment")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.sum("habit_validated").alias("habit_achieved"),
            F.sum("habit_achieved_calculated").alias("habit_computed"),
        )
        .withColumn("habit_rate", rounded_percent(F.col("habit_achieved"), F.col("total_users")))
    )


def habit_parts(onboarding: DataFrame, transactions: DataFrame, rules: Rules) -> DataFrame:
    """The counts behind the habit, of users with anything countable in the window.

    The same rows as a union by name of one part per way of counting, where a
    column that a part lacks is NULL; here as one projection over one join.
    """
    active = _with_habit(with_activity(onboarding, transactions, rules), rules)
    collections = _by_segment(
        rules,
        lambda rule: F.col("window_collections")
        if rule.collections_only
        else F.lit(None).cast("bigint"),
    )
    return active.filter(F.col("total_transactions_period") > 0).select(
        "user_id",
        "user_segment",
        "total_transactions_period",
        "unique_transaction_days",
        collections.alias("total_collection_transactions"),
    )


def onboarding_period(onboarding: DataFrame, rules: Rules) -> DataFrame:
    """Start, closing day and the instant 30 times 24 hours later, per user."""
    return onboarding.select(
        "user_id",
        F.col("first_login_dt").alias("period_start"),
        F.timestamp_add("DAY", F.lit(rules.onboarding_days), "first_login_dt").alias("period_end"),
        onboarding_end(F.col("first_login_dt"), rules.onboarding_days).alias("onboarding_end_dt"),
    )


def activation_in_window(
    onboarding: DataFrame, transactions: DataFrame, rules: Rules
) -> DataFrame:
    """Computed activation: any transaction inside the onboarding window."""
    near = near_windows(onboarding, transactions, rules)
    active = with_activity(onboarding, near, rules)
    inside = F.coalesce(F.col("window_transactions"), F.lit(0))
    return active.select(
        "user_id",
        "activacion",
        inside.alias("window_transactions"),
        _as_int(inside > 0).alias("activated_in_window"),
    )


def drop_from_activity(onboarding: DataFrame, transactions: DataFrame) -> DataFrame:
    """Computed drop: no transaction on a later day than the first login.

    Some transaction is later exactly when the last one is, so one maximum per
    user replaces a join of raw rows.
    """
    last = transactions.groupBy("user_id").agg(F.max("transaction_dt").alias("last_dt"))
    joined = onboarding.select("user_id", "first_login_dt", "return_flag").join(
        last, "user_id", "left"
    )
    came_back = F.to_date("last_dt") > F.to_date("first_login_dt")
    return joined.select(
        "user_id",
        "return_flag",
        drop_flag().alias("drop_flag"),
        _as_int(~F.coalesce(came_back, F.lit(False))).alias("drop_from_activity"),
    )


def _zero_if_none(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def user_flags(onboarding: DataFrame, transactions: DataFrame, rules: Rules) -> DataFrame:
    """The columns of `user_metrics` that funnels and rates count, and no more.

    Flags and segment need no window, so transactions shrink to one row per
    user before they are shuffled; without the segment they are not read.
    """
    return with_segment(onboarding, transactions, rules).select(
        "user_id",
        "first_login_dt",
        "user_segment",
        drop_flag().alias("drop_flag"),
        _zero_if_none("activacion").alias("activation_validated"),
        _zero_if_none("habito").alias("habit_validated"),
        _zero_if_none("setup").alias("setup_achieved"),
    )


def user_metrics(
    onboarding: DataFrame,
    transactions: DataFrame,
    rules: Rules,
    segments: DataFrame | None = None,
) -> DataFrame:
    """One wide row per onboarding user. `onboarding` holds one row per user;
    for `segments` see `with_activity`."""
    return _wide(with_activity(onboarding, transactions, rules, segments), rules)


def user_metrics_from_daily(onboarding: DataFrame, daily: DataFrame, rules: Rules) -> DataFrame:
    """The same rows from the landed table of `daily_activity`, without transactions."""
    return _wide(with_daily_activity(onboarding, daily, rules), rules)


def _wide(measured: DataFrame, rules: Rules) -> DataFrame:
    active = _with_habit(measured, rules)
    login = F.col("first_login_dt")
    has_transactions = _as_int(F.col("total_transactions").isNotNull())

    passed = {n: [n] if n in active.columns else [] for n in PASS_THROUGH}
    return active.withColumn("has_transactions", has_transactions).select(
        "user_id",
        "first_login_dt",
        *passed["week_year"],
        "user_segment",
        _zero_if_none("total_transactions"),
        _zero_if_none("transaction_days"),
        drop_flag().alias("drop_flag"),
        "return_flag",
        *passed["return_dt"],
        _zero_if_none("activacion").alias("activation_validated"),
        *passed["activacion_dt"],
        _zero_if_none("habito").alias("habit_validated"),
        "total_transactions_period",
        "unique_transaction_days",
        _zero_if_none("setup").alias("setup_achieved"),
        *passed["setup_dt"],
        onboarding_end(login, rules.onboarding_days).alias("onboarding_end_dt"),
        F.month(login).alias("first_login_month"),
        F.weekofyear(login).alias("first_login_week"),
        "has_transactions",
        "habit_achieved_calculated",
        _as_int(F.col("activacion") == F.col("has_transactions")).alias("activation_agrees"),
        _as_int(F.col("habito") == F.col("habit_achieved_calculated")).alias("habit_agrees"),
    )


def metric_rates(metrics: DataFrame) -> DataFrame:
    """Users, hits and percentage of each of the four metrics."""
    flags = {
        "drop": "drop_flag",
        "activation": "activation_validated",
        "habit": "habit_validated",
        "setup": "setup_achieved",
    }
    hits = [F.count_if(F.col(c) == 1).alias(m) for m, c in flags.items()]
    totals = metrics.agg(F.count(F.lit(1)).alias("total_users"), *hits)
    tall = totals.unpivot("total_users", list(flags), "metric", "hits")
    return tall.select(
        "metric",
        "hits",
        "total_users",
        percent(F.col("hits"), F.col("total_users")).alias("rate"),
    )
