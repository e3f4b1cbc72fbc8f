"""Which users appear in which tables.

Each id is tagged with one bit per table and the bits are combined per user.
That one shuffle, of at most one row per user and map task, answers every
pairwise and three-way question at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.functions import percent
from firstmile.rules import Rules

# Bits of the tables a user is in, and of what a user did.
USERS, TRANSACTIONS, ONBOARDING = 1, 2, 4
PAID, COLLECTED, TRANSACTED, ONBOARDED = 1, 2, 4, 8


def membership(users: DataFrame, transactions: DataFrame, onboarding: DataFrame) -> DataFrame:
    """(user_id, member) with `member` the sum of the bits of its tables."""
    tagged = [
        df.select("user_id", F.lit(bit).alias("bit"))
        for df, bit in (
            (users, USERS),
            (transactions, TRANSACTIONS),
            (onboarding, ONBOARDING),
        )
    ]
    return (
        reduce(DataFrame.unionAll, tagged)
        .groupBy("user_id")
        .agg(F.bit_or("bit").alias("member"))
    )


def _in_all(bits: int) -> Column:
    return F.count_if(F.col("member").bitwiseAND(F.lit(bits)) == bits)


def overlap_counts(users: DataFrame, transactions: DataFrame, onboarding: DataFrame) -> DataFrame:
    """Distinct users per table, per pair, and in all three."""
    return membership(users, transactions, onboarding).agg(
        _in_all(USERS).alias("users_count"),
        _in_all(TRANSACTIONS).alias("transactions_users_count"),
        _in_all(ONBOARDING).alias("onboarding_users_count"),
        _in_all(USERS | TRANSACTIONS).alias("users_transactions_overlap"),
        _in_all(USERS | ONBOARDING).alias("users_onboarding_overlap"),
        _in_all(TRANSACTIONS | ONBOARDING).alias("transactions_onboarding_overlap"),
        _in_all(USERS | TRANSACTIONS | ONBOARDING).alias("all_three_overlap"),
    )


def coverage_ratios(overlaps: DataFrame) -> DataFrame:
    """Share of the users table found in the other two, in percent."""
    whole = F.col("users_count")
    return overlaps.select(
        "users_count",
        percent(F.col("users_onboarding_overlap"), whole).alias("onboarding_coverage"),
        percent(F.col("users_transactions_overlap"), whole).alias("transaction_coverage"),
    )


def membership_regions(
    users: DataFrame, transactions: DataFrame, onboarding: DataFrame
) -> DataFrame:
    """Users in each non-empty region of the three-set diagram."""

    def within(bit: int) -> Column:
        return F.col("member").bitwiseAND(F.lit(bit)) != 0

    return (
        membership(users, transactions, onboarding)
        .groupBy("member")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .select(
            within(USERS).cast("int").alias("in_users"),
            within(TRANSACTIONS).cast("int").alias("in_transactions"),
            within(ONBOARDING).cast("int").alias("in_onboarding"),
            "user_count",
        )
    )


def prefix_share(tables: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """Distinct ids per table and how many carry the country prefix."""
    tagged = [
        df.select(F.lit(name).alias("dataset"), "user_id") for name, df in tables.items()
    ]
    ids = reduce(DataFrame.unionAll, tagged).distinct()
    return (
        ids.groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("distinct_ids"),
            F.count_if(F.col("user_id").startswith(rules.id_prefix)).alias("with_prefix"),
        )
        .withColumn("share", percent(F.col("with_prefix"), F.col("distinct_ids")))
    )


def _users_by_deed(*tagged: DataFrame) -> DataFrame:
    """(user_id, did): the bits of all rows of a user, in one shuffle."""
    rows = reduce(DataFrame.unionAll, tagged)
    return rows.groupBy("user_id").agg(F.bit_or("bit").alias("did"))


def _did(bit: int) -> Column:
    return F.col("did").bitwiseAND(F.lit(bit)) != 0


def _family_bits(transactions: DataFrame, rules: Rules) -> DataFrame:
    kind = F.col("type")
    return transactions.select(
        "user_id",
        F.when(kind.isin(*rules.payment_types), F.lit(PAID | TRANSACTED))
        .when(kind.isin(*rules.collection_types), F.lit(COLLECTED | TRANSACTED))
        .otherwise(F.lit(TRANSACTED))
        .alias("bit"),
    )


def only_payment_users(transactions: DataFrame, rules: Rules) -> DataFrame:
    """Users with payments, except those with collections."""
    users = _users_by_deed(_family_bits(transactions, rules))
    return users.filter(_did(PAID) & ~_did(COLLECTED)).select("user_id")


def users_without_transactions(onboarding: DataFrame, transactions: DataFrame) -> DataFrame:
    """Onboarding users, except those with transactions."""
    users = _users_by_deed(
        onboarding.select("user_id", F.lit(ONBOARDED).alias("bit")),
        transactions.select("user_id", F.lit(TRANSACTED).alias("bit")),
    )
    return users.filter(~_did(TRANSACTED)).select("user_id")


def segmentation_profile(
    onboarding: DataFrame, transactions: DataFrame, rules: Rules
) -> DataFrame:
    """Only-paying, collecting, transacting and never-transacting users, in one row."""
    users = _users_by_deed(
        _family_bits(transactions, rules),
        onboarding.select("user_id", F.lit(ONBOARDED).alias("bit")),
    )
    return users.agg(
        F.count_if(_did(PAID) & ~_did(COLLECTED)).alias("only_payment_users"),
        F.count_if(_did(COLLECTED)).alias("seller_users"),
        F.count_if(_did(TRANSACTED)).alias("transacting_users"),
        F.count_if(_did(ONBOARDED) & ~_did(TRANSACTED)).alias("users_without_transactions"),
    )
