"""Tables addressed by a data-source format plus options.

The format is a parameter: a keyed store needs its connector on the classpath,
a folder of Parquet files needs nothing. A versioned table is such a folder whose
writes are atomic, and where appending replaces rows by key, as a keyed store does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from firstmile.sources import versions
from firstmile.sources.versions import Layout

VERSIONED = "versioned"
CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"


@dataclass(frozen=True)
class Sink:
    """Where a table is written and read: format, options, write mode, and for
    files the columns that become folders, which later reads prune."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    mode: str = "overwrite"
    partition_by: tuple[str, ...] = ()
    layout: Layout = Layout()
    keep: int = versions.KEEP


def keyed_table(
    table: str,
    keyspace: str,
    format: str = CASSANDRA_FORMAT,
    mode: str = "overwrite",
    truncate: bool = True,
) -> Sink:
    """A table of a keyed store. Overwriting one needs the explicit truncate."""
    options = {"table": table, "keyspace": keyspace}
    if truncate and mode == "overwrite":
        options["confirm.truncate"] = "true"
    return Sink(format, options, mode)


def parquet_table(
    path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> Sink:
    return Sink("parquet", {"path": path}, mode, partition_by)


def versioned_table(path: str, layout: Layout = Layout(), mode: str = "overwrite", keep: int = versions.KEEP) -> Sink:
    """Parquet in versions. With mode "append", rows replace those of the same key."""
    return Sink(VERSIONED, {"path": path}, mode, layout=layout, keep=keep)


def write_table(df: DataFrame, sink: Sink) -> None:
    writer = df.write.format(sink.format).options(**sink.options).mode(sink.mode)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    writer.save()


def read_table(spark: SparkSession, sink: Sink) -> DataFrame:
    if sink.format == VERSIONED:
        return versions.read(spark, sink.options["path"])
    return spark.read.format(sink.format).options(**sink.options).load()
