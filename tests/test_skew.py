"""Rows per task when one user owns a third of all transactions."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from firstmile import Rules
from firstmile.operators import activity, metrics, overlap
from firstmile.operators.dedupe import one_row_per_user

TASKS = 16
RULES = Rules()


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))
    number = F.col("id")
    hot = number % 3 == 0
    start = F.lit("2022-01-10 10:00:00").cast("timestamp_ntz")
    spark.range(0, 240_000, 1, 8).select(
        F.when(hot, F.lit("MLB0")).otherwise(F.concat(F.lit("MLB"), number % 4001)).alias("user_id"),
        F.timestamp_add("MINUTE", (number % 86_400).cast("int"), start).alias("transaction_dt"),
        (1 + number % 7).cast("int").alias("type"),
    ).write.parquet(f"{folder}/transactions")
    # The same user also owns a third of the onboarding rows.
    spark.range(0, 6_000, 1, 8).select(
        F.when(hot, F.lit("MLB0")).otherwise(F.concat(F.lit("MLB"), number % 4001)).alias("user_id"),
        F.timestamp_add("HOUR", (number % 48).cast("int"), start).alias("first_login_dt"),
        *[(number % 2).cast("int").alias(c) for c in ("habito", "activacion", "setup", "return_flag")],
    ).write.parquet(f"{folder}/onboarding")
    return spark.read.parquet(f"{folder}/onboarding"), spark.read.parquet(f"{folder}/transactions")


@pytest.fixture
def wide_shuffles(spark):
    conf = {
        "spark.sql.shuffle.partitions": TASKS,
        "spark.sql.adaptive.coalescePartitions.enabled": False,
        "spark.sql.autoBroadcastJoinThreshold": -1,
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _events(log: str):
    for path in Path(log).rglob("events_*"):
        for line in path.read_text().splitlines():
            if line.endswith("}"):
                yield json.loads(line)


def _wait_for_log(spark, log: str, mark: str) -> None:
    """The log is written behind, in order: run a last job and wait for its end."""
    spark.sparkContext.setJobDescription(mark)
    spark.range(1).count()
    spark.sparkContext.setJobDescription(None)
    for _ in range(60):
        events = list(_events(log))
        marked = {
            e["Job ID"]
            for e in events
            if e["Event"] == "SparkListenerJobStart"
            and (e.get("Properties") or {}).get("spark.job.description") == mark
        }
        if marked & {e["Job ID"] for e in events if e["Event"] == "SparkListenerJobEnd"}:
            return
        time.sleep(0.5)
    raise AssertionError("the event log did not arrive")


def worst_share(spark, log: str, name: str, df) -> float:
    """Largest task over mean task, in rows read from a shuffle, over all stages."""
    spark.sparkContext.setJobDescription(name)
    df.write.format("noop").mode("overwrite").save()
    _wait_for_log(spark, log, f"after {name}")
    stages, read = set(), {}
    for e in _events(log):
        if e["Event"] == "SparkListenerStageSubmitted":
            if (e.get("Properties") or {}).get("spark.job.description") == name:
                stages.add(e["Stage Info"]["Stage ID"])
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            rows = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            read.setdefault(e["Stage ID"], []).append(rows)
    # Small stages are uneven by chance.
    large = [read[s] for s in stages if sum(read.get(s, [])) >= 2_000]
    assert large, "no shuffle was seen"
    return max(max(r) * TASKS / sum(r) for r in large)


def test_window_join_is_even(spark, event_log, extracts, wide_shuffles):
    onboarding, transactions = one_row_per_user(extracts[0]), extracts[1]

    df = metrics.user_metrics(onboarding, transactions, RULES)
    assert worst_share(spark, event_log, "user_metrics", df) < 2
    # The measure itself works: by user alone, one task gets a third of all rows.
    whole = transactions.repartition(TASKS, "user_id")
    assert worst_share(spark, event_log, "by user", whole) > 4


def test_many_busy_users_are_even(spark, event_log, extracts, wide_shuffles):
    """Twenty users who own all rows between them: none stands out, all are large."""
    number = F.col("id")
    busy = spark.range(0, 240_000, 1, 8).select(
        F.concat(F.lit("MLB"), number % 20).alias("user_id"),
        F.timestamp_add("MINUTE", (number % 43_200).cast("int"), F.lit("2022-01-10 10:00:00").cast("timestamp_ntz")).alias("transaction_dt"),
        (1 + number % 7).cast("int").alias("type"),
    )
    df = metrics.user_metrics(one_row_per_user(extracts[0]), busy, RULES)
    assert worst_share(spark, event_log, "busy users", df) < 2


@pytest.mark.parametrize(
    "name, build",
    [
        ("window", lambda o, t: activity.window_transactions(one_row_per_user(o), t, RULES)),
        ("dedupe", lambda o, t: one_row_per_user(o)),
        ("daily", lambda o, t: activity.daily_activity(t, RULES)),
        ("segments", lambda o, t: activity.user_segments(activity.daily_activity(t, RULES), RULES)),
        ("with_segment", lambda o, t: activity.with_segment(one_row_per_user(o), t, RULES)),
        ("activation", lambda o, t: metrics.activation_metric(one_row_per_user(o), t)),
        ("drop", lambda o, t: metrics.drop_from_activity(one_row_per_user(o), t)),
        ("families", lambda o, t: activity.family_membership(t, RULES)),
        ("difference", lambda o, t: overlap.users_without_transactions(o, t)),
        ("regions", lambda o, t: overlap.membership_regions(o, t, o)),
    ],
)
def test_every_shuffle_is_even(spark, event_log, extracts, wide_shuffles, name, build):
    assert worst_share(spark, event_log, name, build(*extracts)) < 2
