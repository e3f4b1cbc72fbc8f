"""Funnel, monthly and weekly tables.

The user table is read once into cohort totals, one row per segment and login
day. Everything served is a roll-up of that small table: grouping sets and
calendar labels never touch user rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import iso_week_label, iso_year, month_label, rounded_percent
from firstmile.functions.rates import rounded_loss_percent

TOTALS = ("total_users", "returned", "activated", "setup", "habit")
# Published names of the five stages, in funnel order.
STAGES = (
    "stage_1_registered",
    "stage_2_returned",
    "stage_3_activated",
    "stage_4_setup",
    "stage_5_habit",
)


def _returned() -> Column:
    return F.when(F.col("drop_flag") == 0, F.lit(1)).otherwise(F.lit(0))


def funnel_stages(metrics: DataFrame) -> DataFrame:
    """The five independent 0/1 stages of each user."""
    return metrics.select(
        "user_id",
        "user_segment",
        F.lit(1).alias("stage_1_registered"),
        _returned().alias("stage_2_returned"),
        F.col("activation_validated").alias("stage_3_activated"),
        F.col("setup_achieved").alias("stage_4_setup"),
        F.col("habit_validated").alias("stage_5_habit"),
    )


def funnel_overall(metrics: DataFrame) -> DataFrame:
    names = ("registered", "returned", "activated", "setup_completed", "habit_achieved")
    return funnel_stages(metrics).agg(
        F.count(F.lit(1)).alias("total_users"),
        *[F.sum(stage).alias(name) for stage, name in zip(STAGES, names)],
    )


def cohort_totals(metrics: DataFrame) -> DataFrame:
    """Five counts per segment and day of first login."""
    return metrics.groupBy(
        "user_segment", F.to_date("first_login_dt").alias("login_date")
    ).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum(_returned()).alias("returned"),
        F.sum("activation_validated").alias("activated"),
        F.sum("setup_achieved").alias("setup"),
        F.sum("habit_validated").alias("habit"),
    )


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in TOTALS]


def funnel_by_dimension(cohorts: DataFrame, with_week: bool = False) -> DataFrame:
    """Overall, per segment and per month number; on request per ISO week."""
    login = F.col("login_date")
    labelled = cohorts.select(
        "user_segment",
        F.month(login).cast("string").alias("month"),
        iso_week_label(iso_year(login), F.weekofyear(login)).alias("week"),
        *TOTALS,
    )
    dimensions = ["user_segment", "month"] + (["week"] if with_week else [])
    sets = [[]] + [[F.col(d)] for d in dimensions]
    grouped = labelled.groupingSets(sets, *[F.col(d) for d in dimensions]).agg(
        *[F.grouping(d).alias(f"without_{d}") for d in dimensions], *_sums()
    )
    kind, value = F.lit("overall"), F.lit("all")
    for d in dimensions:
        present = F.col(f"without_{d}") == 0
        kind = F.when(present, F.lit(d)).otherwise(kind)
        value = F.when(present, F.col(d)).otherwise(value)
    total, *later = TOTALS
    return grouped.select(
        kind.alias("dimension_type"),
        value.alias("dimension_value"),
        total,
        F.col(total).alias(STAGES[0]),
        *[F.col(name).alias(stage) for name, stage in zip(later, STAGES[1:])],
    )


def funnel_conversion(funnel: DataFrame) -> DataFrame:
    """One row per dimension value and stage, with the share of the first and of
    the preceding stage and the users lost in between."""
    steps = []
    for i, stage in enumerate(STAGES):
        before = STAGES[max(i - 1, 0)]
        steps.append(
            F.struct(
                F.lit(i + 1).alias("stage_number"),
                F.lit(stage).alias("stage"),
                F.col(stage).alias("users"),
                rounded_percent(F.col(stage), F.col(STAGES[0])).alias("percent_of_registered"),
                rounded_percent(F.col(stage), F.col(before)).alias("percent_of_previous"),
                (F.col(before) - F.col(stage)).alias("lost_from_previous"),
            )
        )
    return funnel.select(
        "dimension_type", "dimension_value", F.inline(F.array(*steps))
    )


def _bucket_table(cohorts: DataFrame, parts: dict[str, Column], label) -> DataFrame:
    name, make = label
    totals = cohorts.groupBy(
        *[c.alias(n) for n, c in parts.items()], "user_segment"
    ).agg(*_sums())
    whole = F.col("total_users")
    return totals.select(
        make(*[F.col(n) for n in parts]).alias(name),
        "user_segment",
        "total_users",
        F.col("returned").alias("returned_users"),
        F.col("activated").alias("activated_users"),
        F.col("setup").alias("setup_completed_users"),
        F.col("habit").alias("habit_achieved_users"),
        rounded_loss_percent(F.col("returned"), whole).alias("drop_rate"),
        rounded_percent(F.col("activated"), whole).alias("activation_rate"),
        rounded_percent(F.col("setup"), whole).alias("setup_rate"),
        rounded_percent(F.col("habit"), whole).alias("habit_rate"),
    )


def monthly_metrics(cohorts: DataFrame) -> DataFrame:
    login = F.col("login_date")
    parts = {"year": F.year(login), "month": F.month(login)}
    return _bucket_table(cohorts, parts, ("year_month", month_label))


def weekly_metrics(cohorts: DataFrame) -> DataFrame:
    """ISO weeks under their ISO year: 1 January 2022 belongs to 2021-W52."""
    login = F.col("login_date")
    parts = {"year": iso_year(login), "week": F.weekofyear(login)}
    return _bucket_table(cohorts, parts, ("year_week", iso_week_label))
