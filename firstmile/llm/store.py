"""Tables written to the shared folder: they end lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; a temporary one only where that is unset (tests, local mode)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="llm-")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """df as a table written once and read back: later recomputation starts from files, not from df's inputs."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a landed table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def clear(spark: SparkSession, hours: float = 24.0) -> int:
    """Delete landed tables in which nothing has changed for some hours; how many.

    A query's result reads its landed tables until it is written, so give more hours than
    the longest job takes. Runs that are still at work keep theirs.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/llm")
    fs = top.getFileSystem(conf)
    old = [f.getPath() for f in (fs.listStatus(top) if fs.exists(top) else []) if f.getModificationTime() / 1000 <= time.time() - hours * 3600]
    for path in old:
        fs.delete(path, True)
    return len(old)
