"""The three extracts, derived from the customer and events tables.

Customers are users with an onboarding row; events are transactions. The
derivation adds the dirt the cleaning rules are about: foreign and malformed
ids, codes outside their domain, missing times, blank and non-numeric text,
addresses over two lines, and users registered twice with conflicting flags.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstmile.operators.cleaning import (
    clean_onboarding,
    clean_transactions,
    type_onboarding,
    type_transactions,
)
from firstmile.operators.dedupe import one_row_per_user
from firstmile.rules import INDIVIDUALS, SELLERS, UNKNOWN, HabitRule, Rules

HABIT_TRANSACTIONS, HABIT_DAYS, HABIT_COLLECTIONS = 60, 25, 30

# Bounds that cut into both raw tables, for the cleaning queries.
CLEANING_RULES = Rules(date_from="2024-01-01 00:00:00", date_to="2024-01-28 00:00:00")
# Bounds around every login, for the metric queries.
# An event is no purchase, so habits need more of them than in the business.
_OFTEN = HabitRule(min_transactions=HABIT_TRANSACTIONS, min_days=HABIT_DAYS)
METRIC_RULES = Rules(
    date_from="2023-12-01",
    date_to="2024-12-31",
    habit={
        INDIVIDUALS: _OFTEN,
        SELLERS: HabitRule(min_transactions=HABIT_COLLECTIONS, collections_only=True),
        UNKNOWN: _OFTEN,
    },
)

FIRST_LOGIN = "2023-12-20 06:00:00"


def _text(value: Column) -> Column:
    return value.cast("string")


def _days_after(moment: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), moment)


class Inputs:
    """Lazy frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def scratch(self, name: str) -> str:
        """A new path in the folder that driver and executors share, for queries that write."""
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not self.spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            shared = tempfile.mkdtemp(prefix="run-")
        return f"{shared.rstrip('/')}/catalog/{name}-{uuid.uuid4().hex}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def users_raw(self) -> DataFrame:
        key, market = F.col("c_custkey"), F.col("c_mktsegment")
        prefix = (
            F.when(key % 12 == 11, F.lit("MLBX")).when(key % 10 == 9, F.lit("MLA")).otherwise("MLB")
        )
        kind = (
            F.when(key % 7 == 0, F.lit("abc"))
            .when(key % 7 == 1, F.lit(""))
            .when(key % 7 == 2, F.lit(" "))
            .otherwise(F.concat(_text(key % 7), F.lit(".0")))
        )
        rubro = F.when(market == "MACHINERY", _text(F.col("c_nationkey"))).when(
            market == "BUILDING", F.lit("")
        )
        return self.table("customer").select(
            F.concat(prefix, _text(key)).alias("user_id"),
            kind.alias("type"),
            rubro.alias("rubro"),
            F.concat("c_name", F.lit("\n"), market, F.lit("  /  X")).alias("address"),
        )

    @cached_property
    def user_records(self) -> DataFrame:
        """The users as CSV records: of some the last field is missing, some have one more."""
        text = [F.coalesce(F.col(c), F.lit("")) for c in ("user_id", "type", "rubro")]
        address = F.concat(F.lit('"'), "address", F.lit('"'))
        key = F.regexp_extract("user_id", "([0-9]+)$", 1).cast("bigint")
        last = F.when(key % 17 == 0, F.lit("")).otherwise(F.concat(F.lit(","), address))
        more = F.when((key % 17 != 0) & (key % 19 == 0), F.lit(",more")).otherwise(F.lit(""))
        head = F.concat_ws(",", *text)
        return self.users_raw.select(F.concat(head, last, more).alias("record"))

    @cached_property
    def transactions_raw(self) -> DataFrame:
        event, user = F.col("event_id"), F.col("user_id")
        prefix = F.when(user % 10 == 9, F.lit("MLA")).otherwise(F.lit("MLB"))
        return self.table("events").select(
            "event_id",
            F.concat(prefix, _text(user)).alias("user_id"),
            F.when(event % 97 != 0, F.col("ts")).alias("transaction_dt"),
            (event % 11).cast("int").alias("type"),
            (event % 4).cast("int").alias("segment"),
        )

    @cached_property
    def activity_raw(self) -> DataFrame:
        """All events again, each a payment or, for every fifth user, at times a
        collection."""
        event = F.col("event_id")
        collects = F.col("user_id") % 5 == 0
        kind = (
            F.when(collects & (event % 4 == 0), F.lit(8))
            .when(collects & (event % 4 == 2), F.lit(9))
            .otherwise((1 + event % 7).cast("int"))
        )
        return self.table("events").select(
            "event_id",
            F.concat(F.lit("MLB"), _text(F.col("user_id"))).alias("user_id"),
            F.col("ts").alias("transaction_dt"),
            kind.alias("type"),
            F.when(collects, F.lit(2)).otherwise(F.lit(1)).alias("segment"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """The clean transactions of every metric."""
        return clean_transactions(self.activity_raw, METRIC_RULES).drop("segment")

    @cached_property
    def onboarding_raw(self) -> DataFrame:
        """One row per customer, and for some a later, conflicting second one."""
        key, seq = F.col("c_custkey"), F.col("seq")
        copies = F.when(key % 26 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = self.table("customer").select("c_custkey", F.explode(copies).alias("seq"))
        start = F.lit(FIRST_LOGIN).cast("timestamp_ntz")
        first = seq == 0
        logins = rows.select(
            F.concat(F.lit("MLB"), _text(key)).alias("user_id"),
            _days_after(start, key % 35 + seq).alias("first_login_dt"),
            _text(1 + key % 7).alias("week_year"),
            F.when(first & (key % 11 == 0), F.lit(None).cast("double"))
            .when(first & (key % 8 == 0), F.lit(1.0))
            .otherwise(F.lit(0.0))
            .alias("habito"),
            F.when(first, key % 2).otherwise(0).cast("int").alias("activacion"),
            F.when(first & (key % 5 < 2), 1)
            .when(first & (key % 5 == 3), 2)
            .otherwise(0)
            .alias("setup"),
            F.when(first & (key % 13 == 0), F.lit(None).cast("int"))
            .when(first & (key % 4 != 0), 1)
            .otherwise(0)
            .alias("return"),
            "seq",
        )

        def reached(flag: str, days: int) -> Column:
            moment = _days_after(F.col("first_login_dt"), F.lit(days))
            return F.when(F.col(flag) == 1, moment).alias(f"{flag}_dt")

        return logins.select(
            "*",
            reached("habito", 10),
            reached("activacion", 1),
            reached("setup", 2),
            reached("return", 1),
        )

    @cached_property
    def transactions_typed(self) -> DataFrame:
        return type_transactions(self.transactions_raw)

    @cached_property
    def onboarding_typed(self) -> DataFrame:
        return type_onboarding(self.onboarding_raw)

    @cached_property
    def onboarding(self) -> DataFrame:
        """Clean, one row per user: the base of every metric."""
        clean = clean_onboarding(self.onboarding_raw, METRIC_RULES)
        return one_row_per_user(clean, order=("first_login_dt", "seq"))
