"""Distinct users of any period from stored sketches.

Distinct counts do not add up: the users of a month are not the sum of its days. A
HyperLogLog sketch a day and segment does: sketches merge into that of all their users,
so the users of any span are read from a row a day and segment instead of all
transactions. The exact count of the day stands beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.rules import UNKNOWN

#: Logarithm of a sketch's buckets.
BUCKETS = 12


def relative_error(buckets: int = BUCKETS) -> float:
    """Standard error of an estimate, as a share of the count."""
    return 1.04 / 2 ** (buckets / 2)


def daily_users(daily: DataFrame, segments: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A row a day and segment: transactions, exact users, sketch of the users.

    daily: one row a user and day (`daily_activity`), so that its rows of a day are its
    users. Sketches are built before the shuffle: a task sends one a day and segment.
    """
    known = daily.join(segments.select("user_id", "user_segment"), "user_id", "left")
    return (
        known.withColumn("user_segment", F.coalesce("user_segment", F.lit(UNKNOWN)))
        .groupBy("transaction_date", "user_segment")
        .agg(
            F.sum("n").alias("transactions"),
            F.count("user_id").alias("users"),
            F.hll_sketch_agg("user_id", F.lit(buckets)).alias("sketch"),
        )
    )


def distinct_users(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct users and exact transactions of any roll-up of `daily_users`."""
    return sketches.groupBy(*by).agg(
        F.sum("transactions").alias("transactions"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimated_users"),
    )
