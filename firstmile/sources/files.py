"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstmile.functions.rates import rounded_percent
from firstmile.schemas import SchemaMismatch, require, schema_problems
from firstmile.sources import records, versions


def read_text_table(
    spark: SparkSession,
    path: str | list[str],
    expected: T.StructType | None = None,
    multiline: bool = False,
    parallel: bool = False,
    malformed: bool = False,
) -> DataFrame:
    """CSV with a header, every column a string; nothing is inferred.

    Files of a folder must share one header: a file whose columns stand in
    another order fails the read, it is not taken by position.

    `multiline` keeps quoted line breaks inside one record. Such a file is read by
    one task, unless `parallel` finds its records from the quotes in each block; that
    takes one shuffle of the text and needs quotes to stand around whole fields only.

    A record with too few fields ends in NULLs, of one with too many the last are lost.
    With `malformed`, such a record also stands whole in the column `_malformed`, which
    is NULL for all others.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
    )
    names = reader.csv(path).columns
    first = reader.option("header", False).csv(path).first()
    # A saved index has no name in the header; Spark names it by its place.
    headers = ["" if first and not first[i] else name for i, name in enumerate(names)]
    if headers.count("") > 1:
        raise SchemaMismatch(f"{path}: more than one column without a name")
    if multiline and parallel:
        df = records.read_records(spark, path, names, headers, malformed)
    else:
        more = [records.MALFORMED] if malformed else []
        fields = [T.StructField(name, T.StringType()) for name in (*headers, *more)]
        checked = reader.option("header", True).option("enforceSchema", False)
        checked = checked.option("columnNameOfCorruptRecord", records.MALFORMED)
        df = checked.schema(T.StructType(fields)).csv(path).toDF(*names, *more)
    return require(df, expected, str(path)) if expected is not None else df


def read_parquet(
    spark: SparkSession, path: str, expected: T.StructType | None = None
) -> DataFrame:
    """Parquet scan; with `expected`, names and types are checked, not guessed.

    Of a table that `write_parquet` wrote, the last version whose write ended.
    """
    versioned = versions.current(spark, path) is not None
    df = versions.read(spark, path) if versioned else spark.read.parquet(path)
    if expected is not None:
        problems = schema_problems(df, expected)
        if problems:
            raise SchemaMismatch(f"{path}: {'; '.join(problems)}")
    return df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a new version and return the number of rows written, taken during the write itself.

    A write that fails leaves the table as it was. Read it with `read_parquet`.
    """
    if mode == "append":
        before = versions.current(df.sparkSession, path)
        return versions.append(df, path).rows - (before.rows if before else 0)
    if mode != "overwrite":
        raise ValueError(f"mode {mode}: overwrite or append")
    return versions.overwrite(df, path).rows


def parsing_impact(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """How many records a reader that ignores quoted line breaks would invent.

    `line_rows` is what a line-by-line reader returns, `record_rows` the truth, both
    without headers. Both come from one pass that counts lines and quotes.
    """
    per_file = records.blocks(spark, path).groupBy("file").agg(
        (F.sum("lines") - 1).alias("lines"), (F.sum("records") - 1).alias("records")
    )
    counts = per_file.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("line_rows"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("record_rows"),
    )
    invented = F.col("line_rows") - F.col("record_rows")
    return counts.withColumn(
        "reduction_percent", rounded_percent(invented, F.col("line_rows"))
    )
