"""Control and treatment groups, and whether they differ.

The lift of a metric is its rate in the treatment group less that in control. Its
interval comes twice: in closed form from the two proportions, and from a Poisson
bootstrap in which every user is drawn 0, 1, 2, ... times in every replicate. The draw
is a hash of user and replicate, so it needs no seed or state, is the same in every run
and on every engine, and sums up in one pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import rounded_percent
from firstmile.functions.rates import rounded_loss_percent
from firstmile.rules import Rules

CONTROL, TREATMENT, UNASSIGNED = "control", "treatment", "unassigned"


def group_of(rules: Rules, user_id: str = "user_id") -> Column:
    """Group from the last two digits of the numeric id, so that it is stable
    across runs and engines, for a number of any length. An id without a number
    is unassigned."""
    number = F.regexp_extract(user_id, rules.id_digits, 1)
    bucket = F.right(number, F.lit(2)).try_cast("int")
    return (
        F.when(bucket < rules.control_percent, F.lit(CONTROL))
        .when(bucket.isNotNull(), F.lit(TREATMENT))
        .otherwise(F.lit(UNASSIGNED))
    )


def ab_groups(users: DataFrame, rules: Rules) -> DataFrame:
    return users.select("user_id", group_of(rules).alias("ab_group"))


def outside_control(users: DataFrame, rules: Rules) -> DataFrame:
    """Users who are not held back: the treatment group and the unassigned."""
    return users.filter(group_of(rules) != CONTROL)


def ab_metrics(metrics: DataFrame, rules: Rules) -> DataFrame:
    """Counts and rates of the four metrics, per group."""
    totals = metrics.groupBy(group_of(rules).alias("ab_group")).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("drop_flag") == 0).alias("returned_users"),
        F.sum("activation_validated").alias("activated_users"),
        F.sum("setup_achieved").alias("setup_completed_users"),
        F.sum("habit_validated").alias("habit_achieved_users"),
    )
    whole = F.col("total_users")
    return totals.select(
        "*",
        rounded_loss_percent(F.col("returned_users"), whole).alias("drop_rate"),
        rounded_percent(F.col("activated_users"), whole).alias("activation_rate"),
        rounded_percent(F.col("setup_completed_users"), whole).alias("setup_rate"),
        rounded_percent(F.col("habit_achieved_users"), whole).alias("habit_rate"),
    )


# The four metrics, as users that count for each.
HITS = {
    "return": "drop_flag = 0",
    "activation": "activation_validated = 1",
    "setup": "setup_achieved = 1",
    "habit": "habit_validated = 1",
}
#: Two-sided 95 per cent of the normal distribution.
Z = 1.959963984540054
REPLICATES = 200
DIGITS = 6


def _hits() -> list[Column]:
    return [F.count_if(F.expr(condition)).alias(name) for name, condition in HITS.items()]


def _in_pairs(totals: DataFrame, *more: str) -> DataFrame:
    """One row per metric (and `more`): users and hits of control and of treatment."""
    tall = totals.unpivot([*more, "ab_group", "users"], list(HITS), "metric", "hits")

    def of(group: str, value: str) -> Column:
        inside = F.col("ab_group") == group
        return F.coalesce(F.sum(F.when(inside, F.col(value))), F.lit(0))

    return tall.groupBy(*more, "metric").agg(
        *[of(g, v).alias(f"{g}_{v}") for g in (CONTROL, TREATMENT) for v in ("users", "hits")]
    )


def _rate(group: str) -> Column:
    return F.try_divide(F.col(f"{group}_hits").cast("double"), F.col(f"{group}_users").cast("double"))


def ab_lift(metrics: DataFrame, rules: Rules) -> DataFrame:
    """Lift of each metric in percentage points, its 95 per cent interval, and the
    z statistic of the test that both groups have one rate. NULL without users."""
    grouped = metrics.withColumn("ab_group", group_of(rules))
    totals = grouped.groupBy("ab_group").agg(F.count(F.lit(1)).alias("users"), *_hits())
    pairs = _in_pairs(totals)
    control, treatment = F.col("control_users"), F.col("treatment_users")
    p, q = _rate(CONTROL), _rate(TREATMENT)
    lift = q - p
    spread = F.sqrt(F.try_divide(p * (1 - p), control) + F.try_divide(q * (1 - q), treatment))
    both = F.try_divide(F.col("control_hits") + F.col("treatment_hits"), control + treatment)
    even = F.sqrt(both * (1 - both) * (F.try_divide(F.lit(1.0), control) + F.try_divide(F.lit(1.0), treatment)))
    z = F.try_divide(lift, even)

    def points(value: Column) -> Column:
        return F.round(value * 100.0, DIGITS)

    return pairs.select(
        "metric",
        "control_users",
        "control_hits",
        "treatment_users",
        "treatment_hits",
        points(lift).alias("lift"),
        points(lift - Z * spread).alias("lift_low"),
        points(lift + Z * spread).alias("lift_high"),
        F.round(z, DIGITS).alias("z"),
        F.coalesce(F.abs(z) > Z, F.lit(False)).alias("differs"),
    )


def _poisson_steps() -> list[float]:
    """Where the distribution function of a Poisson variable of mean 1 steps up."""
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append(total)
    return steps


def draws(user_id: str, replicate: str) -> Column:
    """How often a user is drawn in a replicate: Poisson of mean 1, from 32 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.col(user_id), F.col(replicate)))
    uniform = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)
    count = F.lit(0)
    for step in _poisson_steps():
        count = count + F.when(uniform >= step, F.lit(1)).otherwise(F.lit(0))
    return count


def ab_bootstrap(metrics: DataFrame, rules: Rules, replicates: int = REPLICATES) -> DataFrame:
    """The middle 95 per cent of each metric's lift over Poisson bootstrap replicates.

    Sums combine before the shuffle, so what moves is a row a task, group and replicate.
    """
    flags = [F.when(F.expr(condition), F.lit(1)).otherwise(F.lit(0)).alias(name) for name, condition in HITS.items()]
    users = metrics.select("user_id", group_of(rules).alias("ab_group"), *flags)
    drawn = users.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    drawn = drawn.withColumn("w", draws("user_id", "replicate"))
    totals = drawn.groupBy("replicate", "ab_group").agg(
        F.sum("w").alias("users"), *[F.sum(F.col(name) * F.col("w")).alias(name) for name in HITS]
    )
    lifts = _in_pairs(totals, "replicate").withColumn("lift", _rate(TREATMENT) - _rate(CONTROL))

    def at(share: float) -> Column:
        return F.round(F.percentile("lift", F.lit(share)) * 100.0, DIGITS)

    return lifts.groupBy("metric").agg(
        F.count("lift").alias("replicates"), at(0.025).alias("lift_low"), at(0.975).alias("lift_high")
    )
