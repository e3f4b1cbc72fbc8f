"""Columns and batches shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until df has no such column, in whatever letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """df through `run`, which keeps its columns; they may have any names."""
    names, plain = df.columns, [f"c{i}" for i in range(len(df.columns))]
    held = df.toDF(*plain)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain)

    return held.mapInArrow(renamed, held.schema).toDF(*names)


def id_remainder(column: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a NULL id counts as empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % divisor


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).alias("text")


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column's values as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that one batch's Python objects stay few."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def portions(batches: Iterator[pa.RecordBatch], name: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text in column `name` takes about `size` bytes; a longer text comes alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy()
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
