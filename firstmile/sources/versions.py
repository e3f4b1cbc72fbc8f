"""Tables whose every write is a new version that readers see at once or not at all.

A table is a folder:

    version=00000003-1f2e3d4c/by_month=2022-03/by_bucket=7/part-....parquet
    _commits/00000003

A write fills a version folder of its own, then publishes one small commit file that
names the folders of the table from now on. The commit file appears by one rename that
fails if its number is taken, so of two writers one is told to begin again. Readers
take the commit with the highest number: a write that is killed leaves a folder that no
commit names, and the rows before it stay readable.

A `Layout` cuts the files by month of a date and by bucket of a key. Both are folders,
so a read of one key and month prunes to the files that can hold it, and an upsert
rewrites the folders its rows fall into and takes the others over as they are.

The commit holds the number of rows and a digest of them that does not depend on their
order. Both are taken while the rows are written; `problems` recomputes them on reading.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass
from datetime import date

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH, BUCKET = "by_month", "by_bucket"
#: Committed versions that stay readable, and hours after which a folder without a commit is taken for abandoned.
KEEP, ABANDONED_HOURS = 2, 24.0


class Conflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


class DuplicateKeys(ValueError):
    """A table breaks its contract: a key is NULL or occurs twice."""


class DamagedWrite(RuntimeError):
    """What was written cannot be read back whole; it was not committed."""


@dataclass(frozen=True)
class Layout:
    """Folders by month of the column `time` and by one of `buckets` of the column `key`."""

    time: str | None = None
    key: str | None = None
    buckets: int = 1

    def columns(self) -> dict[str, Column]:
        out = {}
        if self.time:
            out[MONTH] = F.coalesce(F.date_format(self.time, "yyyy-MM"), F.lit("none"))
        if self.key:
            out[BUCKET] = self._bucket(F.col(self.key))
        return out

    def _bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.buckets)).cast("int")

    def schema(self) -> list[T.StructField]:
        kinds = {MONTH: T.StringType(), BUCKET: T.IntegerType()}
        return [T.StructField(n, kinds[n]) for n in self.columns()]

    def fields(self) -> set[str]:
        return {n for n in (self.time, self.key) if n}


@dataclass(frozen=True)
class Version:
    """A committed state of a table: its folders, below the table's, and what they hold."""

    number: int
    folders: tuple[str, ...]
    rows: int
    digest: int
    schema: str
    layout: Layout = Layout()

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class _Folder:
    """The few file operations a table needs, in whatever store its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.root = path.rstrip("/")
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, pattern: str) -> list[tuple[str, float]]:
        """Files and folders that match, with the hour of their last change."""
        found = self.fs.globStatus(self._at(pattern))
        top = self._at("").toUri().getPath().rstrip("/") + "/"
        return [(f.getPath().toUri().getPath().removeprefix(top), f.getModificationTime() / 3.6e6) for f in found or []]

    def text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """The file whole, or Conflict if there is one of that name."""
        draft = f"_commits/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._at(draft), self._at(name), plain)
        except Py4JJavaError as error:
            self.drop(draft)
            if is_instance_of(self.gateway, error.java_exception, "org.apache.hadoop.fs.FileAlreadyExistsException"):
                raise Conflict(f"{self.root}: {name} was committed by another writer") from None
            raise

    def drop(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(n.rpartition("/")[2]) for n, _ in folder.names("_commits/[0-9]*"))


def _load(folder: _Folder, number: int) -> Version:
    held = json.loads(folder.text(f"_commits/{number:08d}"))
    held["layout"], held["folders"] = Layout(**held["layout"]), tuple(held["folders"])
    return Version(**held)


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The last committed version, or that of a number; None where the folder is no such table."""
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    if number is None:
        return _load(folder, numbers[-1]) if numbers else None
    if number not in numbers:
        raise LookupError(f"{path}: version {number} is not kept")
    return _load(folder, number)


def _scan(spark: SparkSession, path: str, version: Version, folders: tuple[str, ...]) -> DataFrame:
    """Rows of some of a version's folders, with the layout's columns."""
    layout = version.layout.schema()
    whole = T.StructType([*version.struct().fields, T.StructField("version", T.StringType()), *layout])
    if not folders:
        return spark.createDataFrame([], whole).drop("version")
    reader = spark.read.schema(whole).option("basePath", path)
    return reader.parquet(*[f"{path.rstrip('/')}/{f}" for f in folders]).drop("version")


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the last committed version, or of one that is still kept."""
    version = current(spark, path, number)
    if version is None:
        raise LookupError(f"{path}: no committed version")
    return _scan(spark, path, version, version.folders).select(*version.struct().names)


def lookup(spark: SparkSession, path: str, key: object = None, since: date | None = None, until: date | None = None) -> DataFrame:
    """Rows of one key and of days from `since` to `until`, inclusive.

    Months and buckets are folders, so only files that can hold such rows are listed in
    the scan; inside them, rows lie in the order of the key.
    """
    version = current(spark, path)
    if version is None:
        raise LookupError(f"{path}: no committed version")
    layout, df = version.layout, _scan(spark, path, version, version.folders)
    if key is not None:
        if not layout.key:
            raise ValueError(f"{path} is not laid out by a key")
        value = F.lit(key).cast(version.struct()[layout.key].dataType)
        # A number, not an expression: the folders are picked while the query is planned.
        bucket = spark.range(1).select(layout._bucket(value).alias("b")).first()["b"]
        df = df.where((F.col(BUCKET) == bucket) & (F.col(layout.key) == value))
    if since is not None or until is not None:
        if not layout.time:
            raise ValueError(f"{path} is not laid out by time")
        if since is not None:
            df = df.where((F.col(MONTH) >= since.strftime("%Y-%m")) & (F.to_date(layout.time) >= F.lit(since)))
        if until is not None:
            df = df.where((F.col(MONTH) <= until.strftime("%Y-%m")) & (F.to_date(layout.time) <= F.lit(until)))
    return df.select(*version.struct().names)


def row_digest(names: list[str]) -> Column:
    """64 bits of a row. NULLs are told from their neighbours' values by a flag each."""
    return F.xxhash64(*[c for n in names for c in (F.col(f"`{n}`"), F.col(f"`{n}`").isNull())])


def _digest_sum(names: list[str], where: Column) -> Column:
    return F.sum(F.when(where, row_digest(names)).cast("decimal(38,0)"))


def _hashable(schema: T.StructType) -> list[str]:
    """Columns that a hash takes: all but those with maps inside."""
    return [f.name for f in schema.fields if "map<" not in f.dataType.simpleString()]


def problems(spark: SparkSession, path: str, number: int | None = None) -> list[str]:
    """What differs between a version's rows as they are now and as they were written."""
    version = current(spark, path, number)
    if version is None:
        return [f"{path}: no committed version"]
    names = _hashable(version.struct())
    found = read(spark, path, version.number).agg(F.count(F.lit(1)).alias("rows"), _digest_sum(names, F.lit(True)).alias("digest")).first()
    out = []
    if found["rows"] != version.rows:
        out.append(f"{path}: {found['rows']} rows, {version.rows} committed")
    if int(found["digest"] or 0) != version.digest:
        out.append(f"{path}: content differs from what was written")
    return out


def _folders_of(folder: _Folder, stamp: str, layout: Layout) -> list[str]:
    """The partition folders of a write, or its one folder."""
    depth = len(layout.columns())
    return sorted(n for n, _ in folder.names("/".join([f"version={stamp}", *["*=*"] * depth])))


def _store(
    df: DataFrame,
    path: str,
    number: int,
    layout: Layout,
    key: tuple[str, ...],
    order: list[Column],
    old: DataFrame | None = None,
) -> tuple[str, int, int]:
    """Write the rows of a new version folder; its stamp, rows and digest.

    Rows of `old` stay unless df has their key. One shuffle by the layout's folders
    brings both together; a key lies in one folder, so repeated keys meet there too.
    """
    spark, folder, stamp = df.sparkSession, _Folder(df.sparkSession, path), f"{number:08d}-{uuid.uuid4().hex[:8]}"
    names, cut = df.columns, list(layout.columns())
    rows = df.withColumn("_new", F.lit(1))
    if old is not None:
        rows = rows.unionByName(old.select(*names).withColumn("_new", F.lit(0)))
    rows = rows.withColumns(layout.columns())
    if cut:
        rows = rows.repartition(*cut)
    first, again = F.lit(True), F.lit(False)
    if key and cut:
        nth = F.row_number().over(Window.partitionBy(*cut, *key).orderBy(F.desc("_new")))
        rows = rows.withColumn("_nth", nth)
        first = F.col("_nth") == 1
        again = (F.col("_new") == 1) & (~first | F.greatest(F.lit(False), *[F.col(f"`{k}`").isNull() for k in key]))
    seen, hashed = Observation(), _hashable(df.schema)
    watched = rows.observe(
        seen, F.count_if(first).alias("rows"), F.count_if(again).alias("again"), _digest_sum(hashed, first).alias("digest")
    )
    kept = watched.where(first) if key and cut else watched
    if cut or order:
        kept = kept.sortWithinPartitions(*cut, *order)
    # A folder of its own a version, so nothing that a reader may hold open is replaced.
    writer = kept.select(*names, *cut).write.mode("errorifexists")
    try:
        (writer.partitionBy(*cut) if cut else writer).parquet(f"{path.rstrip('/')}/version={stamp}")
        counts = seen.get
        if counts["again"]:
            raise DuplicateKeys(f"{path}: {counts['again']} rows have a NULL or repeated key {key}")
    except BaseException:
        folder.drop(f"version={stamp}")
        if not _numbers(folder) and not folder.names("version=*"):
            folder.drop("")
        raise
    return stamp, counts["rows"], int(counts["digest"] or 0)


def _publish(spark: SparkSession, path: str, version: Version, keep: int) -> Version:
    """Make a version the current one, after its files are seen to be there."""
    folder = _Folder(spark, path)
    new = {f.split("/")[0] for f in version.folders if int(f[len("version=") :].split("-")[0]) == version.number}
    for name in new:
        if not folder.names(f"{name}/_SUCCESS"):
            if _next(folder) > version.number:  # another writer has committed and pruned
                raise Conflict(f"{path}: version {version.number} was committed by another writer")
            raise DamagedWrite(f"{path}/{name}: the write did not end")
    try:
        folder.put_new(f"_commits/{version.number:08d}", json.dumps(asdict(version)))
    except Conflict:
        for name in new:
            folder.drop(name)
        raise
    prune(spark, path, keep)
    return version


def _next(folder: _Folder) -> int:
    return (_numbers(folder) or [0])[-1] + 1


def _checked(layout: Layout, key: tuple[str, ...]) -> Layout:
    if key and not layout.fields() <= set(key):
        raise ValueError(f"folders by {sorted(layout.fields())} would part rows of one key {key}")
    return layout


def overwrite(
    df: DataFrame, path: str, layout: Layout = Layout(), key: tuple[str, ...] = (), order: list[Column] | None = None, keep: int = KEEP
) -> Version:
    """df as the table's new version. With a layout, keys are checked in the same job."""
    folder = _Folder(df.sparkSession, path)
    number = _next(folder)
    stamp, rows, digest = _store(df, path, number, _checked(layout, key), key, order or [])
    folders = tuple(_folders_of(folder, stamp, layout))
    return _publish(df.sparkSession, path, Version(number, folders, rows, digest, df.schema.json(), layout), keep)


def append(df: DataFrame, path: str, keep: int = KEEP) -> Version:
    """The table's rows and those of df, whatever their keys."""
    spark, folder = df.sparkSession, _Folder(df.sparkSession, path)
    now = current(spark, path)
    if now is None:
        return overwrite(df, path, keep=keep)
    df = df.select(*_same_schema(df, now, path).names)
    number = now.number + 1
    stamp, rows, digest = _store(df, path, number, now.layout, (), [])
    folders = now.folders + tuple(_folders_of(folder, stamp, now.layout))
    return _publish(spark, path, Version(number, folders, now.rows + rows, now.digest + digest, now.schema, now.layout), keep)


def upsert(
    df: DataFrame, path: str, key: tuple[str, ...], layout: Layout = Layout(), order: list[Column] | None = None, keep: int = KEEP
) -> Version:
    """The table with df's rows in place of those with the same key.

    Only folders that df has rows for are read and rewritten. The table keeps the layout
    of its first write.
    """
    spark, folder = df.sparkSession, _Folder(df.sparkSession, path)
    now = current(spark, path)
    if now is None:
        # One bucket gives repeated keys a place to meet.
        return overwrite(df, path, layout if layout.columns() else Layout(key=key[0]), key, order, keep)
    df, layout = df.select(*_same_schema(df, now, path).names), _checked(now.layout, key)
    if not layout.columns():
        raise ValueError(f"{path} has no folders to upsert into; write it with a layout")
    cut = list(layout.columns())
    # A row a folder, of which a table has a bounded number.
    touched = {tuple(str(v) for v in r) for r in df.select(*(c.alias(n) for n, c in layout.columns().items())).distinct().collect()}
    place = lambda f: tuple(part.split("=", 1)[1] for part in f.split("/")[1:])
    gone = tuple(f for f in now.folders if place(f) in touched)
    old = _scan(spark, path, now, gone).drop(*cut)
    lost = old.agg(F.count(F.lit(1)).alias("rows"), _digest_sum(_hashable(now.struct()), F.lit(True)).alias("digest")).first()
    number = now.number + 1
    stamp, rows, digest = _store(df, path, number, layout, key, order or [], old)
    folders = tuple(f for f in now.folders if f not in gone) + tuple(_folders_of(folder, stamp, layout))
    version = Version(number, folders, now.rows - lost["rows"] + rows, now.digest - int(lost["digest"] or 0) + digest, now.schema, layout)
    return _publish(spark, path, version, keep)


def _same_schema(df: DataFrame, now: Version, path: str) -> T.StructType:
    have, want = ({f.name: f.dataType for f in s.fields} for s in (df.schema, now.struct()))
    if have != want:
        raise ValueError(f"{path} holds {now.struct().simpleString()}, not {df.schema.simpleString()}")
    return now.struct()


def prune(spark: SparkSession, path: str, keep: int = KEEP, abandoned_hours: float = ABANDONED_HOURS) -> list[str]:
    """Delete commits but the last `keep`, the folders that only they name, and abandoned writes; their names.

    A folder without a commit may belong to a write that still runs, so it goes only
    when nothing has changed in it for some hours.
    """
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    kept = numbers[-max(1, keep) :]
    for number in numbers[: -max(1, keep)]:
        folder.drop(f"_commits/{number:08d}")
    live = {f for n in kept for f in _load(folder, n).folders}
    whole = {f.split("/")[0] for f in live}
    newest = kept[-1] if kept else 0
    dropped = []
    for name, hour in folder.names("version=*"):
        if name in whole:
            # Parts that were rewritten since. All folders of a table are equally deep.
            depth = next(iter(live)).count("/")
            gone = [n for n, _ in folder.names("/".join([name, *["*=*"] * depth])) if depth and n not in live]
        elif int(name[len("version=") :].split("-")[0]) <= newest and folder.names(f"{name}/_SUCCESS"):
            gone = [name]  # its commit was passed over, or its number was taken by another
        else:
            gone = [name] if time.time() / 3600 - hour >= abandoned_hours else []
        for n in gone:
            folder.drop(n)
        dropped += gone
    return dropped
