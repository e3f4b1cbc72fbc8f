"""Ordered funnel: a stage counts only after the one before it, and inside the window.

The stages of `funnel` are independent flags, so a user can be set up without having
returned. Here each stage has moments, and a user reaches it at the first of them that
is neither before the moment of the stage before nor after the end of the window. What
a stage loses is then what really went on from the stage before and stopped there.

A stage has one moment a user, in a column, or many, as rows of an event table. Events
are joined to users by day: of the day on which the stage before was reached the rows
themselves are needed, of later days only each day's first one. No task gets more than
a day of one user, whatever share of the events that user owns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import at_midnight, onboarding_end, rounded_percent
from firstmile.functions.rates import seconds_between
from firstmile.rules import Rules


@dataclass(frozen=True)
class Stage:
    """A stage by its name, and when it happens: a column of the user table, or events
    (user_id, `moment`), any number a user."""

    name: str
    moment: str
    events: DataFrame | None = None


def _from_events(reached: DataFrame, stage: Stage, after: str, last: str) -> DataFrame:
    """user_id and the first event from `after` to `last`, of users who have one."""
    events = stage.events.select("user_id", F.col(stage.moment).alias("_moment"))
    events = events.withColumn("_day", F.to_date("_moment"))
    users = reached.filter(F.col(after).isNotNull()).select("user_id", after, last)
    same_day = (
        events.join(users.withColumn("_day", F.to_date(after)), ["user_id", "_day"])
        .filter(F.col("_moment") >= F.col(after))
        .select("user_id", "_moment", last)
    )
    first_of_day = events.groupBy("user_id", "_day").agg(F.min("_moment").alias("_moment"))
    later = (
        first_of_day.join(users, "user_id")
        .filter(F.col("_day") > F.to_date(after))
        .select("user_id", "_moment", last)
    )
    found = same_day.unionAll(later).filter(F.col("_moment") <= F.col(last))
    return found.groupBy("user_id").agg(F.min("_moment").alias(stage.name))


def ordered_stages(onboarding: DataFrame, stages: list[Stage], rules: Rules) -> DataFrame:
    """When each user reached each stage, NULL where not. `onboarding`: one row per user.

    The first stage is the login itself; its window ends as that of every metric.
    """
    end = onboarding_end(F.col("first_login_dt"), rules.onboarding_days)
    closing = at_midnight(onboarding, end, like="first_login_dt")
    first, *later = stages
    reached = onboarding.withColumns({first.name: F.col("first_login_dt"), "_last": closing})
    before = first.name
    for stage in later:
        if stage.events is None:
            moment = F.col(stage.moment)
            counts = (moment >= F.col(before)) & (moment <= F.col("_last"))
            reached = reached.withColumn(stage.name, F.when(counts, moment))
        else:
            found = _from_events(reached, stage, before, "_last")
            reached = reached.join(found, "user_id", "left")
        before = stage.name
    return reached.drop("_last")


def ordered_funnel(reached: DataFrame, names: list[str], by: str = "user_segment") -> DataFrame:
    """One row per value of `by` and stage: users, losses to the stage before, mean hours since it."""
    waits = [
        F.sum(seconds_between(F.col(before), F.col(name))).alias(f"wait_{i}")
        for i, (before, name) in enumerate(zip(names, names[1:]), start=1)
    ]
    totals = reached.groupBy(by).agg(
        *[F.count(name).alias(f"users_{i}") for i, name in enumerate(names)], *waits
    )
    steps = []
    for i, name in enumerate(names):
        users, before = F.col(f"users_{i}"), F.col(f"users_{max(i - 1, 0)}")
        hours = F.try_divide(F.col(f"wait_{i}"), users * 3600.0) if i else F.lit(None).cast("double")
        steps.append(
            F.struct(
                F.lit(i + 1).alias("stage_number"),
                F.lit(name).alias("stage"),
                users.alias("users"),
                (before - users).alias("lost_from_previous"),
                rounded_percent(users, F.col("users_0")).alias("percent_of_first"),
                rounded_percent(users, before).alias("percent_of_previous"),
                F.round(hours, 2).alias("mean_hours_from_previous"),
            )
        )
    return totals.select(by, F.inline(F.array(*steps)))
