"""Records of CSV files with line breaks inside quotes, read by many tasks a file.

A reader that must know whether a line break is quoted has to read from the start of
the file, so Spark gives such a file to one task. But whether a line begins inside
quotes is only the parity of the quotes before it (a doubled quote counts two). That is
a prefix sum: each block of a file counts its quotes and, for either parity at its
start, the records that begin in it; the sums over the blocks before, a row a block,
give each block its parity and its first record's number. Lines that are records by
themselves, nearly all, are then parsed where they are; the pieces of the others are
put together by their record's number.

Quotes may stand only around a field and, doubled, inside one, as RFC 4180 has it.
Blank lines between records are no records. Lines end with a line feed, or with carriage
return and line feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firstmile.operators.cleaning import MALFORMED

QUOTING = {"quote": '"', "escape": '"'}

_BLOCK = ("file", "block")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, block and order within it."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def _blank() -> Column:
    return F.col("value").isin("", "\r")


def _within() -> dict[str, Column]:
    """Of a line: parity of the block's quotes before it, and records begun up to it, in
    case the block itself begins outside (begun_0) or inside quotes (begun_1)."""
    earlier = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    parity = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    return {
        "parity": parity,
        **{f"begun_{p}": F.sum(F.when((F.col("parity") == p) & ~F.col("blank"), 1).otherwise(0)).over(upto) for p in (0, 1)},
    }


def _counted(lines: DataFrame) -> DataFrame:
    counted = lines.withColumns({"quotes": _quotes(), "blank": _blank()})
    for name, value in _within().items():
        counted = counted.withColumn(name, value)
    return counted


def blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row a block of each file: lines, parity at its start, records begun before it and in it.

    Only counts of lines move here, not their text.
    """
    totals = _counted(_lines(spark, path)).groupBy(*_BLOCK).agg(
        F.count_if(~F.col("blank")).alias("lines"),
        (F.sum("quotes") % 2).alias("odd"),
        F.max("begun_0").alias("begun_0"),
        F.max("begun_1").alias("begun_1"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = totals.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    records = inside.withColumn("records", F.when(F.col("inside") == 0, F.col("begun_0")).otherwise(F.col("begun_1")))
    before = F.coalesce(F.sum("records").over(earlier), F.lit(0))
    return records.select(*_BLOCK, "lines", "odd", "inside", "records", before.alias("before"))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, number, record): the text of every record, numbered from 1 in its file.

    A file whose quotes do not pair fails, as its records cannot be told.
    """
    known = blocks(spark, path)
    unpaired = known.groupBy("file").agg((F.sum("odd") % 2).alias("unpaired"))
    # A row a block of input: small beside it, whatever its size.
    placed = F.broadcast(known.join(unpaired, "file").select(*_BLOCK, "inside", "before", "unpaired"))
    lines = _counted(_lines(spark, path)).join(placed, [*_BLOCK])
    fails = F.raise_error(F.concat(F.col("file"), F.lit(": quotes do not pair"))).cast("long")
    begun = F.when(F.col("inside") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))
    numbered = lines.withColumns(
        {
            "number": F.when(F.col("unpaired") == 1, fails).otherwise(F.col("before") + begun),
            "open": (F.col("parity") + F.col("inside")) % 2 == 1,
        }
    ).filter(F.col("open") | ~F.col("blank"))
    alone = ~F.col("open") & (F.col("quotes") % 2 == 0)
    whole = numbered.filter(alone).select("file", "number", F.col("value").alias("record"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    joined = (
        numbered.filter(~alone)
        .groupBy("file", "number")
        .agg(F.array_join(pieces["value"], "\n").alias("record"))
    )
    return whole.unionAll(joined)


def parse(lines: DataFrame, names: list[str], malformed: bool = False) -> DataFrame:
    """Fields of the column `record`, all strings. With `malformed`, a record of another
    number of fields stands whole in that column, else NULL is there."""
    fields = [*names, MALFORMED]
    options = {**QUOTING, "columnNameOfCorruptRecord": MALFORMED}
    # A carriage return before the line feed belongs to the line's end.
    text = F.rtrim(F.col("record"), F.lit("\r"))
    parsed = lines.select(F.from_csv(text, _ddl(fields), options).alias("r"))
    kept = fields if malformed else fields[:-1]
    return parsed.select(*[F.col("r")[n].alias(n) for n in kept])


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def read_records(
    spark: SparkSession, path: str | list[str], names: list[str], headers: list[str], malformed: bool = False
) -> DataFrame:
    """Every file's records but its header, which must be the same in all files."""
    found = records(spark, path)
    header = F.from_csv(F.rtrim(F.col("record"), F.lit("\r")), _ddl([f"c{i}" for i in range(len(headers))]), QUOTING)
    expected = F.struct(*[F.lit(h or None).cast("string").alias(f"c{i}") for i, h in enumerate(headers)])
    other = F.raise_error(F.concat(F.lit("CSV header of "), F.col("file"), F.lit(" differs: "), F.col("record")))
    checked = found.withColumn(
        "record", F.when((F.col("number") == 1) & ~header.eqNullSafe(expected), other.cast("string")).otherwise(F.col("record"))
    )
    # The check is part of what is kept, so that it is not optimized away.
    body = checked.filter((F.col("number") > 1) | F.col("record").isNull())
    return parse(body, names, malformed)
