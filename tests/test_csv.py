"""CSV with quoted line breaks and doubled quotes."""

import pytest
from helpers import rows
from pyspark.sql import types as T

from firstmile import schemas
from firstmile.schemas import SchemaMismatch
from firstmile.sources import parsing_impact, read_parquet, read_text_table, records, write_parquet

USERS = ',user_id,type,rubro,address\n0,MLB1,1.0,,"a, 1\nb\nsay ""q"""\n1,MLB2,2,3,plain\n'


@pytest.fixture
def users_csv(tmp_path):
    path = tmp_path / "users.csv"
    path.write_text(USERS)
    return str(path)


def test_multiline_records(spark, users_csv):
    df = read_text_table(spark, users_csv, schemas.RAW_USERS, multiline=True)
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.columns[0] == "_c0"
    assert rows(df, "user_id", "type", "rubro", "address") == [
        ("MLB1", "1.0", None, 'a, 1\nb\nsay "q"'),
        ("MLB2", "2", "3", "plain"),
    ]


def test_line_reader_invents_records(spark, users_csv):
    assert read_text_table(spark, users_csv).count() == 4
    assert rows(parsing_impact(spark, users_csv)) == [(4, 2, 50.0)]


def test_folder_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(USERS.replace("MLB", f"MLB{i}"))
    assert read_text_table(spark, str(tmp_path), multiline=True).count() == 6
    assert rows(parsing_impact(spark, str(tmp_path))) == [(12, 6, 50.0)]


def test_columns_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,type,rubro,address\nMLB1,1,2,b st\n")
    (tmp_path / "b.csv").write_text("user_id,address,rubro,type\nMLB2,b st,2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        read_text_table(spark, str(tmp_path)).collect()


def test_missing_column_is_an_error(spark, users_csv):
    with pytest.raises(SchemaMismatch, match="transaction_dt"):
        read_text_table(spark, users_csv, schemas.RAW_TRANSACTIONS)


def test_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, None), ("b", None, 2)], "k string, d double, n int")
    path = str(tmp_path / "t")
    assert write_parquet(df, path) == 2
    assert rows(read_parquet(spark, path, df.schema)) == rows(df)
    assert write_parquet(df, path, mode="append") == 2
    assert read_parquet(spark, path).count() == 4
    other = T.StructType([T.StructField("k", T.LongType()), T.StructField("z", T.LongType())])
    with pytest.raises(SchemaMismatch, match="k: string, not bigint; z: missing"):
        read_parquet(spark, path, other)


def test_odd_headers(spark, tmp_path):
    from firstmile.operators import quality

    (tmp_path / "odd.csv").write_text("Unnamed: 0,a.b,`c`\n1,x,\n2,x,y\n")
    df = read_text_table(spark, str(tmp_path))
    assert rows(quality.quality_profile(df), "column_name", "null_count") == [
        ("Unnamed: 0", 0), ("`c`", 1), ("a.b", 0),
    ]
    assert rows(quality.duplicate_rows({"odd": df}), "distinct_rows") == [(2,)]
    assert quality.preview(df, quality.all_columns(df), 1).count() == 1


def test_schema_listing(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert rows(schemas.schema_listing(df)) == [(0, "k", "string", True), (1, "n", "int", True)]
    assert schemas.missing_columns(df, ["k", "other"]) == ["other"]
    assert schemas.schema_problems(df, df.schema) == []


AWKWARD = (
    'id,name,note\n1,"a\nb","x ""q"" y"\n\n2,,""\n3,"l1\r\nl2\n\nl3",z\n4," sp ", q \n'
    '5,"""",","\n6,"a,b\n""\n""c",\\\n7,é漢😀,"\n"\n'
)


def awkward_file(path, times):
    head, body = AWKWARD.split("\n", 1)
    path.write_bytes((head + "\n" + body * times).encode())
    return str(path)


@pytest.fixture
def small_blocks(spark):
    """Files are read in many blocks, so that lines and quotes straddle them."""
    conf = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = awkward_file(tmp_path / "a.csv", 400)
    whole = read_text_table(spark, path, multiline=True)
    parts = read_text_table(spark, path, multiline=True, parallel=True)
    assert whole.rdd.getNumPartitions() == 1
    blocks = records.blocks(spark, path)
    assert blocks.count() > 8 and blocks.filter("inside = 1").count() > 0
    assert rows(parts) == rows(whole) and parts.count() == 2800
    assert rows(parsing_impact(spark, path), "line_rows", "record_rows") == [
        (read_text_table(spark, path).count(), 2800)
    ]


def test_records_of_many_files(spark, tmp_path, small_blocks):
    for i in range(3):
        awkward_file(tmp_path / f"{i}.csv", 30 * (i + 1))
    whole, parts = (read_text_table(spark, str(tmp_path), multiline=True, parallel=p) for p in (False, True))
    assert rows(parts) == rows(whole)
    (tmp_path / "9.csv").write_text("id,note,name\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        read_text_table(spark, str(tmp_path), multiline=True, parallel=True).collect()


def test_carriage_returns_and_missing_ends(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b'id,note\r\n1,"a\r\nb"\r\n\r\n2,c\r\n3,')
    assert rows(read_text_table(spark, str(path), multiline=True, parallel=True)) == [
        ("1", "a\r\nb"), ("2", "c"), ("3", None),
    ]


def test_quotes_that_do_not_pair_are_an_error(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note\n1,"a\n2,b\n')
    with pytest.raises(Exception, match="quotes do not pair"):
        read_text_table(spark, str(path), multiline=True, parallel=True).collect()


def test_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n")
    assert read_text_table(spark, str(tmp_path), multiline=True, parallel=True).collect() == []
    assert rows(parsing_impact(spark, str(tmp_path)), "line_rows", "record_rows") == [(0, 0)]


@pytest.mark.parametrize("how", [{}, {"multiline": True}, {"multiline": True, "parallel": True}])
def test_records_of_another_width_are_kept(spark, tmp_path, how):
    path = tmp_path / "a.csv"
    path.write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\n,,\n5\n")
    df = read_text_table(spark, str(path), malformed=True, **how)
    assert rows(df, "_malformed", "a", "b", "c") == [
        (None, None, None, None), (None, "1", "2", "3"),
        ("1,2", "1", "2", None), ("1,2,3,4", "1", "2", "3"), ("5", "5", None, None),
    ]
    assert "_malformed" not in read_text_table(spark, str(path), **how).columns
