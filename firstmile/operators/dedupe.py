"""One deterministic row per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_user(
    onboarding: DataFrame,
    order: Sequence[str] = ("first_login_dt",),
    key: str = "user_id",
) -> DataFrame:
    """The smallest row of each user by `order`, then by every other column.

    A minimum, unlike a ranking window, is combined before the shuffle: a user
    with a third of all rows sends one row per map task. It also leaves the
    result hashed and sorted by the key, which the joins downstream reuse.
    """
    rest = [c for c in onboarding.columns if c != key and c not in order]
    smallest = F.min(F.struct(*order, *rest)).alias("smallest")
    return (
        onboarding.groupBy(key)
        .agg(smallest)
        .select(key, *[F.col("smallest")[c].alias(c) for c in onboarding.columns if c != key])
    )
