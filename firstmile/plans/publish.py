"""Writing served tables under their contract."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firstmile.schemas import Contract, conform, schema_problems
from firstmile.sources import versions
from firstmile.sources.keyed import VERSIONED, Sink, read_table, write_table
from firstmile.sources.versions import DuplicateKeys

WRITTEN, FALLBACK = "written", "fallback"


@dataclass(frozen=True)
class Published:
    """What became of one table. `error` says why the fallback was used, `digest`
    is that of the table's content, in whatever order."""

    table: str
    status: str
    format: str
    rows: int
    error: str | None = None
    digest: int | None = field(default=None, compare=False)


def bad_keys(df: DataFrame, contract: Contract) -> DataFrame:
    """Keys that occur more than once or have a NULL part."""
    per_key = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("copies"))
    incomplete = F.lit(False)
    for name in contract.key:
        incomplete = incomplete | F.col(name).isNull()
    return per_key.filter((F.col("copies") > 1) | incomplete)


def _reason(error: Exception) -> str:
    """One line that names the cause; a JVM error hides it behind a call trace."""
    text = error.java_exception.toString() if isinstance(error, Py4JJavaError) else str(error)
    return f"{type(error).__name__}: {text.strip().splitlines()[0]}"


def _content(df: DataFrame) -> list[Column]:
    """Rows and digest of a table, for an observation or an aggregate."""
    digest = versions.row_digest(df.columns).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest")]


def _write(table: DataFrame, contract: Contract, sink: Sink) -> tuple[int, int | None]:
    """Write in the contract's order; rows and digest of the table then, taken in the same job.

    Appending to a keyed store leaves rows there that this job does not see, so it has
    no digest; a versioned table adds up its own.
    """
    if sink.format == VERSIONED:
        write = versions.upsert if sink.mode == "append" else versions.overwrite
        key = contract.key if sink.layout.columns() or sink.mode == "append" else ()
        made = write(table, sink.options["path"], layout=sink.layout, key=key, order=contract.order(), keep=sink.keep)
        return made.rows, made.digest
    ordered = table.sortWithinPartitions(*sink.partition_by, *contract.order())
    seen = Observation()
    write_table(ordered.observe(seen, *_content(table)), sink)
    return seen.get["rows"], int(seen.get["digest"] or 0) if sink.mode == "overwrite" else None


def publish(
    df: DataFrame, contract: Contract, sink: Sink, fallback: Sink | None = None
) -> Published:
    """Check the contract, then write to `sink`, else to `fallback`.

    A versioned sink with a layout checks the keys in the job that writes, and commits
    only after. For any other the keys are checked before anything is written, so hand
    in a landed or small table: it is read twice. Only a failing write leads to the
    fallback, and its reason is part of the result; without a fallback it is raised.
    """
    table = conform(df, contract)
    checks_itself = sink.format == VERSIONED and (sink.mode == "append" or bool(sink.layout.columns()))
    if not checks_itself and not bad_keys(table, contract).isEmpty():
        raise DuplicateKeys(f"{contract.name}: key {contract.key} is not unique")
    try:
        rows, digest = _write(table, contract, sink)
        return Published(contract.name, WRITTEN, sink.format, rows, digest=digest)
    except (PySparkException, Py4JJavaError) as error:
        if fallback is None:
            raise
        rows, digest = _write(table, contract, fallback)
        return Published(contract.name, FALLBACK, fallback.format, rows, _reason(error), digest)


def status_table(spark: SparkSession, published: Iterable[Published]) -> DataFrame:
    return spark.createDataFrame(
        [(p.table, p.status, p.format, p.rows, p.error) for p in published],
        "table string, status string, format string, rows bigint, error string",
    )


def verify(spark: SparkSession, result: Published, contract: Contract, sink: Sink) -> list[str]:
    """Read a table back and compare it with its contract, reported size and content."""
    try:
        found = read_table(spark, sink)
    except (PySparkException, Py4JJavaError) as error:
        return [f"{contract.name}: unreadable ({type(error).__name__})"]
    problems = [f"{contract.name}.{p}" for p in schema_problems(found, contract.schema)]
    names = [n for n in contract.schema.names if n in found.columns]
    now = found.agg(*_content(found.select(*names))).first()
    if now["rows"] != result.rows:
        problems.append(f"{contract.name}: {now['rows']} rows, reported {result.rows}")
    elif result.digest is not None and int(now["digest"] or 0) != result.digest:
        problems.append(f"{contract.name}: content differs from what was written")
    return problems
