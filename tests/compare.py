"""Run catalogue queries on Spark and DuckDB and compare schema and rows.

As a script: python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


# Spark type -> the one DuckDB type that the comparison accepts.
DUCK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a DuckDB result; empty if nothing."""
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_names = [d[0] for d in result.description]
    found = [f for f in df.columns if f not in duck_types]
    lost = [n for n in duck_names if n not in df.columns]
    if found or lost or len(duck_names) != len(df.columns):
        return [f"columns only in Spark {found}, only in SQL {lost}"]
    out = []
    for f in df.schema.fields:
        want = DUCK_TYPES.get(f.dataType.simpleString())
        if want != duck_types[f.name]:
            out.append(f"{f.name}: {f.dataType.simpleString()} vs {duck_types[f.name]}")
    names = sorted(df.columns)
    position = {n: i for i, n in enumerate(duck_names)}
    theirs = [tuple(r[position[n]] for n in names) for r in result.fetchall()]
    ours = [tuple(r[n] for n in names) for r in df.collect()]
    if len(ours) != len(theirs):
        return out + [f"{len(ours)} rows vs {len(theirs)}"]
    for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return out + [f"row {dict(zip(names, a))} vs {dict(zip(names, b))}"]
    return out


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", False)
        .config("spark.sql.shuffle.partitions", 8)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    sqls, bad = entry.oracle_sql(), 0
    wanted = sys.argv[2:] or list(entry.queries())
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            problems = differences(df, con, sqls[name])
        except Exception as error:  # report and go on to the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name:32s} {time.time() - start:6.2f}s", *problems, flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} match; without SQL: {set(entry.queries()) - set(sqls)}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
