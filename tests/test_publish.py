"""Contracts, key checks, fallback, read-back."""

from datetime import date, datetime

import pytest
from helpers import rows

from firstmile import schemas
from firstmile.plans.publish import DuplicateKeys, Published, publish, status_table, verify
from firstmile.schemas import SchemaMismatch, conform
from firstmile.sources import keyed_table, parquet_table, read_table

DDL = "user_id string, transaction_date date, n bigint, pay bigint, col bigint, kinds int"
DAY = date(2022, 1, 1)


def daily(spark, *keys):
    data = [(u, d, 3, 2, 1, 2) for u, d in keys]
    names = schemas.TRANSACTION_SUMMARY.schema.names
    return spark.createDataFrame(data, DDL).toDF(*names)


def test_round_trip(spark, tmp_path):
    sink = parquet_table(str(tmp_path / "daily"))
    df = daily(spark, ("a", DAY), ("a", date(2022, 1, 2)), ("b", DAY))
    result = publish(df, schemas.TRANSACTION_SUMMARY, sink)
    assert result == Published("transaction_summary", "written", "parquet", 3)
    back = read_table(spark, sink)
    assert back.schema.simpleString() == schemas.TRANSACTION_SUMMARY.schema.simpleString()
    assert verify(spark, result, schemas.TRANSACTION_SUMMARY, sink) == []
    wrong = Published("transaction_summary", "written", "parquet", 4)
    assert len(verify(spark, wrong, schemas.TRANSACTION_SUMMARY, sink)) == 1


def test_latest_day_first_in_a_file(spark, tmp_path):
    sink = parquet_table(str(tmp_path / "daily"))
    days = [date(2022, 1, d) for d in (3, 1, 2)]
    publish(daily(spark, *[("a", d) for d in days]).coalesce(1), schemas.TRANSACTION_SUMMARY, sink)
    assert [r[1].day for r in read_table(spark, sink).collect()] == [3, 2, 1]


def test_folders_by_column(spark, tmp_path):
    sink = parquet_table(str(tmp_path / "daily"), partition_by=("transaction_date",))
    df = daily(spark, ("b", DAY), ("a", DAY), ("a", date(2022, 1, 2))).coalesce(1)
    result = publish(df, schemas.TRANSACTION_SUMMARY, sink)
    assert verify(spark, result, schemas.TRANSACTION_SUMMARY, sink) == []
    assert len(list((tmp_path / "daily").glob("transaction_date=*"))) == 2
    one = read_table(spark, sink).filter("transaction_date = date'2022-01-01'")
    assert [r["user_id"] for r in one.collect()] == ["a", "b"]
    assert "PartitionFilters: [isnotnull(transaction_date" in (
        one._jdf.queryExecution().executedPlan().toString()
    )


@pytest.mark.parametrize("keys", [[("a", DAY), ("a", DAY)], [(None, DAY)], [("a", None)]])
def test_bad_keys_stop_before_writing(spark, tmp_path, keys):
    path = tmp_path / "daily"
    with pytest.raises(DuplicateKeys):
        publish(daily(spark, *keys), schemas.TRANSACTION_SUMMARY, parquet_table(str(path)))
    assert not path.exists()


def test_failing_sink_falls_back_and_says_why(spark, tmp_path):
    absent = keyed_table("transaction_summary", "analytics", format="no.such.connector")
    spare = parquet_table(str(tmp_path / "spare"))
    df = daily(spark, ("a", DAY))
    result = publish(df, schemas.TRANSACTION_SUMMARY, absent, spare)
    assert (result.status, result.rows, result.format) == ("fallback", 1, "parquet")
    assert "no.such.connector" in result.error
    assert verify(spark, result, schemas.TRANSACTION_SUMMARY, spare) == []
    assert rows(status_table(spark, [result]), "table", "status") == [("transaction_summary", "fallback")]
    with pytest.raises(Exception, match="no.such.connector"):
        publish(df, schemas.TRANSACTION_SUMMARY, absent)


def test_unreadable_table_is_reported(spark, tmp_path):
    missing = parquet_table(str(tmp_path / "nothing"))
    result = Published("transaction_summary", "written", "parquet", 1)
    assert "unreadable" in verify(spark, result, schemas.TRANSACTION_SUMMARY, missing)[0]


def test_overwrite_of_a_keyed_table_is_explicit():
    assert keyed_table("t", "k").options == {"table": "t", "keyspace": "k", "confirm.truncate": "true"}
    assert keyed_table("t", "k", mode="append").options == {"table": "t", "keyspace": "k"}


def test_missing_column_and_overflow(spark):
    with pytest.raises(SchemaMismatch, match="transaction_date"):
        conform(spark.createDataFrame([("a",)], "user_id string"), schemas.TRANSACTION_SUMMARY)
    huge = spark.createDataFrame([("a", DAY, 2**40, 0, 0, 1)], DDL)
    huge = huge.toDF(*schemas.TRANSACTION_SUMMARY.schema.names)
    before = spark.conf.get("spark.sql.ansi.enabled")
    for ansi in (True, False):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="transaction_count does not fit INT"):
            conform(huge, schemas.TRANSACTION_SUMMARY).collect()
    spark.conf.set("spark.sql.ansi.enabled", before)
    wide = conform(huge, schemas.TRANSACTION_SUMMARY.with_wide_counts())
    assert wide.first()["transaction_count"] == 2**40


def test_zoned_variant(spark):
    zoned = schemas.USER_SEGMENTS.with_instants()
    assert dict(zoned.schema.jsonValue()["fields"][5])["type"] == "timestamp"
    moment = datetime(2022, 1, 1, 10)
    df = spark.createDataFrame(
        [("a", "SELLERS", 1, 1, 1, moment, moment)],
        "a string, b string, c int, d int, e int, f timestamp_ntz, g timestamp_ntz",
    ).toDF(*zoned.schema.names)
    assert conform(df, zoned).first()["last_transaction_dt"] is not None


def test_one_row_smoke_table(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "id string, test_value int")
    contract = schemas.Contract("smoke", df.schema, key=("id",))
    sink = parquet_table(str(tmp_path / "smoke"))
    assert publish(df, contract, sink).rows == 1
    assert rows(read_table(spark, sink)) == [("x", 1)]
    spark.sql("DROP TABLE IF EXISTS smoke")
