"""Versioned tables: atomic writes, upserts by key, pruned reads, digests of content."""

from datetime import date, timedelta

import pytest
from compare import differences, duck
from conftest import SMALL
from helpers import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from firstmile import schemas
from firstmile.catalog.inputs import METRIC_RULES, Inputs
from firstmile.operators import activity
from firstmile.plans.publish import publish, verify
from firstmile.sources import Layout, read_parquet, read_table, versioned_table, versions, write_parquet

DDL = "user_id string, day date, n int"
FIRST = date(2022, 1, 1)
LAYOUT = Layout("day", "user_id", 4)
KEY = ("user_id", "day")


def table(spark, users=20, days=90, n=1):
    data = [(f"u{u}", FIRST + timedelta(days=3 * d), n) for u in range(users) for d in range(days // 3)]
    return spark.createDataFrame(data, DDL)


def failing(df):
    """df, of which one row cannot be computed, late in its partition."""
    broken = F.when(F.col("user_id") == "u9", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("n"))
    return df.withColumn("n", broken)


def test_a_failing_write_leaves_the_rows_before_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(table(spark), path)
    with pytest.raises(Exception, match="killed"):
        write_parquet(failing(table(spark, n=2)), path)
    with pytest.raises(Exception, match="killed"):
        versions.append(failing(table(spark, n=2)), path)
    assert rows(read_parquet(spark, path)) == rows(table(spark))
    assert len(list((tmp_path / "t").glob("version=*"))) == 1
    assert write_parquet(table(spark, users=2), path) == 60 == read_parquet(spark, path).count()


def test_a_killed_write_is_never_seen_and_goes_after_a_while(spark, tmp_path):
    path = tmp_path / "t"
    write_parquet(table(spark), str(path))
    stray = path / "version=00000002-dead0000"
    table(spark, n=5).write.parquet(str(stray))
    (stray / "_SUCCESS").unlink()
    assert rows(read_parquet(spark, str(path))) == rows(table(spark))
    assert versions.prune(spark, str(path)) == [] and stray.exists()
    assert versions.prune(spark, str(path), abandoned_hours=0) == [stray.name] and not stray.exists()
    assert versions.problems(spark, str(path)) == []


def test_the_first_write_that_fails_leaves_nothing(spark, tmp_path):
    with pytest.raises(Exception, match="killed"):
        write_parquet(failing(table(spark)), str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()
    with pytest.raises(LookupError):
        versions.read(spark, str(tmp_path / "t"))


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_parquet(table(spark), path)
    publish_now = versions._publish

    def late(session, where, version, keep):
        monkeypatch.setattr(versions, "_publish", publish_now)
        versions.append(table(spark, users=1, days=3, n=7), path)
        return publish_now(session, where, version, keep)

    monkeypatch.setattr(versions, "_publish", late)
    with pytest.raises(versions.Conflict):
        write_parquet(table(spark, n=2), path)
    assert read_parquet(spark, path).count() == 601
    assert len(list((tmp_path / "t").glob("version=*"))) == 2
    assert sorted(f.name for f in (tmp_path / "t" / "_commits").iterdir() if not f.name.endswith(".crc")) == ["00000001", "00000002"]
    folder = versions._Folder(spark, path)
    with pytest.raises(versions.Conflict):
        folder.put_new("_commits/00000002", "{}")
    assert versions.current(spark, path).rows == 601


def test_old_versions_go_by_a_parameter(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        versions.overwrite(table(spark, users=n + 1), path, keep=3)
    assert [versions.read(spark, path, k).count() for k in (3, 4, 5)] == [90, 120, 150]
    with pytest.raises(LookupError):
        versions.read(spark, path, 2)
    assert len(list((tmp_path / "t").glob("version=*"))) == 3
    versions.prune(spark, path, keep=1)
    assert len(list((tmp_path / "t").glob("version=*"))) == 1


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(table(spark), path)
    held = read_parquet(spark, path)
    write_parquet(table(spark, n=2), path)
    assert held.agg(F.sum("n")).first()[0] == 600


def test_upsert_replaces_by_key_and_rewrites_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    before = versions.upsert(table(spark), path, KEY, LAYOUT)
    new = spark.createDataFrame([("u1", FIRST, 50), ("u1", FIRST + timedelta(days=1), 51), ("zz", date(2023, 1, 1), 52)], DDL)
    after = versions.upsert(new, path, KEY)
    kept = set(before.folders) & set(after.folders)
    assert len(set(before.folders) - kept) == 1 and len(set(after.folders) - kept) == 2
    want = {(u, d): n for u, d, n in rows(table(spark))} | {(u, d): n for u, d, n in rows(new)}
    assert rows(versions.read(spark, path)) == sorted((u, d, n) for (u, d), n in want.items())
    assert after.rows == len(want) and versions.problems(spark, path) == []
    assert versions.upsert(new, path, KEY).digest == after.digest
    versions.prune(spark, path, keep=1)
    assert versions.problems(spark, path) == []
    versions.upsert(table(spark, n=9), path, KEY)
    assert versions.problems(spark, path) == [] and versions.read(spark, path).count() == len(want)


def test_repeated_and_missing_keys_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite(table(spark), path, LAYOUT, KEY)
    for bad in ([("u1", FIRST, 1), ("u1", FIRST, 2)], [(None, FIRST, 1)], [("u1", None, 1)]):
        for write in (versions.upsert, lambda df, p, k: versions.overwrite(df, p, LAYOUT, k)):
            with pytest.raises(versions.DuplicateKeys):
                write(spark.createDataFrame(bad, DDL), path, KEY)
    assert rows(versions.read(spark, path)) == rows(table(spark)) and versions.current(spark, path).number == 1
    with pytest.raises(ValueError, match="would part rows"):
        versions.overwrite(table(spark), path, LAYOUT, ("user_id",))
    with pytest.raises(ValueError, match="not struct"):
        versions.upsert(table(spark).withColumn("n", F.lit("x")), path, KEY)


def test_nothing_written_and_nothing_upserted(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite(table(spark).limit(0), path, LAYOUT, KEY)
    assert versions.read(spark, path).collect() == [] and versions.problems(spark, path) == []
    versions.upsert(table(spark).limit(0), path, KEY)
    versions.upsert(table(spark, users=1), path, KEY)
    assert versions.read(spark, path).count() == 30


def test_a_key_and_month_are_read_from_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite(table(spark, users=40, days=360), path, LAYOUT, KEY)
    one = versions.lookup(spark, path, "u7", date(2022, 3, 1), date(2022, 3, 31))
    assert rows(one) == [r for r in rows(table(spark, users=40, days=360)) if r[0] == "u7" and r[1].month == 3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    folders, pushed = line.split("PartitionFilters: ")[1].split("PushedFilters: ")
    assert "by_bucket" in folders and ">= 2022-03" in folders and "EqualTo(user_id,u7)" in pushed
    assert len(one.inputFiles()) == 48  # of the table; the scan lists
    scanned = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(scanned) == 1 and "by_month=2022-03" in scanned[0]["f"]
    with pytest.raises(ValueError, match="not laid out by time"):
        versions.overwrite(table(spark), path, Layout(key="user_id"), KEY)
        versions.lookup(spark, path, "u1", since=FIRST)


def test_a_changed_cell_is_found(spark, tmp_path):
    contract = schemas.Contract("t", table(spark).schema, key=KEY)
    sink = versioned_table(str(tmp_path / "t"), LAYOUT)
    result = publish(table(spark), contract, sink)
    assert verify(spark, result, contract, sink) == []
    damaged = next((tmp_path / "t").glob("version=*/*/*/*.parquet"))
    held = spark.read.parquet(str(damaged))
    one = held.orderBy("user_id", "day").first()
    at = (F.col("user_id") == one["user_id"]) & (F.col("day") == F.lit(one["day"]))
    held.withColumn("n", F.when(at, F.lit(None)).otherwise(F.col("n"))).coalesce(1).write.parquet(str(tmp_path / "other"))
    damaged.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    damaged.with_name(f".{damaged.name}.crc").unlink()
    assert verify(spark, result, contract, sink) == ["t: content differs from what was written"]
    assert versions.problems(spark, sink.options["path"]) == [f"{sink.options['path']}: content differs from what was written"]


def test_digests_see_where_a_null_stands(spark):
    digest = lambda *r: spark.createDataFrame([r], "a int, b int").select(versions.row_digest(["a", "b"]).alias("d")).first()["d"]
    assert digest(1, None) != digest(None, 1) and digest(None, None) != digest(0, 0)


def test_publishing_month_by_month_equals_publishing_at_once(spark, tmp_path):
    daily = activity.daily_summary(activity.daily_activity(Inputs(spark, SMALL).transactions, METRIC_RULES)).cache()
    contract, sink = schemas.TRANSACTION_SUMMARY, versioned_table(str(tmp_path / "t"), Layout("transaction_date", "user_id", 2), mode="append")
    months = sorted(r[0] for r in daily.select(F.date_trunc("month", "transaction_date")).distinct().collect())
    for month in months:
        # Each portion begins a week early: those rows are published twice.
        part = daily.where((F.col("transaction_date") >= F.date_sub(F.lit(month), 7)) & (F.date_trunc("month", "transaction_date") <= F.lit(month)))
        result = publish(part.where(F.col("transaction_date") < F.add_months(F.lit(month), 1)), contract, sink)
    assert verify(spark, result, contract, sink) == []
    assert result.rows == daily.count()
    assert differences(read_table(spark, sink), duck(SMALL), entry.oracle_sql()["transaction_summary_daily"]) == []
    daily.unpersist()
