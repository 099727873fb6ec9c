"""Datasets that are replaced in one step, and a ledger of finished stages.

``overwrite`` deletes the old files before it writes new ones, so a reader in
between, or after a failed write, finds nothing. Here every write goes to a folder
of its own, ``<path>/v-<number>-<id>``, and only when that is complete a small file,
``<path>/_current``, is replaced by a rename. It names the folder, its schema and the fingerprint of what it
was made from. Readers resolve the file, so they see the old rows or the new ones,
and those who read the old folder can finish. ``prune`` removes old folders when nobody
reads them any more.

The fingerprint makes the file a ledger entry: a stage whose inputs have the same fingerprint
as its current version is finished, and ``Ledger.stage`` gives that version
without building or running anything. The fingerprint of a stage's output is in turn an input of the next
stage, so changed files run again all that depends on them.

Only names, sizes and times of files are read on the driver, through Hadoop's
file systems, so any store that Spark writes to will do. A rename over an
existing file is one step on HDFS and local disks; on an object store it is as atomic as its connector makes it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lodestar.sources.files import write_parquet

POINTER = "_current"


@dataclass(frozen=True)
class Buckets:
    """How rows are dealt to files: by the hash of ``column``, sorted by it inside a file.

    Datasets with equal buckets are joined on the column without a shuffle.
    """

    column: str
    number: int

    def write(self, df: DataFrame, folder: str) -> None:
        """Write ``df`` with one file a bucket."""
        table = _table_name(folder)
        (df.repartition(self.number, self.column).write.format("parquet").mode("overwrite")
         .bucketBy(self.number, self.column).sortBy(self.column).option("path", folder).saveAsTable(table))

    def read(self, spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
        """The rows as a table that knows its buckets; it is declared in the session, which starts no job."""
        table = _table_name(folder)
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{self.column}`) "
                      f"SORTED BY (`{self.column}`) INTO {self.number} BUCKETS LOCATION '{folder}'")
        return spark.table(table)


def _table_name(folder: str) -> str:
    return "lodestar_" + hashlib.sha256(folder.encode()).hexdigest()[:24]


@dataclass(frozen=True)
class Version:
    """The current version of a dataset."""

    path: str
    name: str
    schema: StructType
    fingerprint: str | None
    buckets: Buckets | None = None

    @property
    def folder(self) -> str:
        return f"{self.path}/{self.name}"

    @property
    def number(self) -> int:
        return int(self.name.split("-")[1])

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows, columns in the order they were written; starts no job."""
        if self.buckets is not None:
            return self.buckets.read(spark, self.folder, self.schema).select(*self.schema.fieldNames())
        return spark.read.schema(self.schema).parquet(self.folder).select(*self.schema.fieldNames())


# --------------------------------------------------------------------------
# files of a store


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` beside ``path`` and rename it over ``path``."""
    jvm = spark.sparkContext._jvm
    new, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        new.toUri() if new.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), how)


def list_files(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the visible files below files, folders or patterns, sorted; starts no job."""
    out = []
    for path in paths:
        p, fs = _fs(spark, path)
        for found in fs.globStatus(p) or []:
            todo = [found]
            while todo:
                s = todo.pop()
                name = s.getPath().getName()
                if s.isDirectory():
                    todo += list(fs.listStatus(s.getPath()))
                elif not name.startswith(("_", ".")):
                    out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(set(out))


# --------------------------------------------------------------------------
# versions


def current(spark: SparkSession, path: str) -> Version | None:
    """The current version of the dataset at ``path``; None if it was never published."""
    path = path.rstrip("/")
    text = _read_text(spark, f"{path}/{POINTER}")
    if text is None:
        return None
    entry = json.loads(text)
    buckets = Buckets(*entry["buckets"]) if entry["buckets"] else None
    return Version(path, entry["version"], StructType.fromJson(entry["schema"]), entry["fingerprint"], buckets)


def publish(df: DataFrame, path: str, partition_by: Iterable[str] = (), fingerprint: str | None = None,
            check: Callable[[DataFrame], object] | None = None, buckets: Buckets | None = None) -> Version:
    """Write ``df`` as the next version of the dataset at ``path`` and make it the current one in one step.

    ``check`` gets the written rows first; if it raises, the old version stays.
    ``buckets`` deals the rows to files by hash instead of ``partition_by``.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = current(spark, path)
    name = f"v-{before.number + 1 if before else 1:08d}-{uuid.uuid4().hex[:8]}"
    if buckets is not None:
        buckets.write(df, f"{path}/{name}")
    else:
        write_parquet(df, f"{path}/{name}", partition_by)
    made = Version(path, name, df.schema, fingerprint, buckets)
    if check is not None:
        check(made.read(spark))
    _replace_text(spark, f"{path}/{POINTER}", json.dumps(
        {"version": name, "fingerprint": fingerprint, "schema": df.schema.jsonValue(),
         "buckets": [buckets.column, buckets.number] if buckets else None}))
    return made


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version of the dataset at ``path``."""
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of {path} was published")
    return version.read(spark)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the version folders at ``path``, oldest first, unfinished ones included."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("v-"))


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the current version and the ``keep`` - 1 before it; returns the names of what went.

    Newer folders than the current one (of a failed or running write) stay.
    """
    now = current(spark, path)
    if now is None:
        return []
    older = [n for n in versions(spark, path) if n < now.name]
    gone = older[:max(0, len(older) - (keep - 1))]
    for name in gone:
        p, fs = _fs(spark, f"{path.rstrip('/')}/{name}")
        fs.delete(p, True)
    return gone


# --------------------------------------------------------------------------
# ledger


def fingerprint(*parts) -> str | None:
    """SHA-256 of the parts; None if a part is None, for inputs of which nothing is known."""
    if any(p is None for p in parts):
        return None
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """Of the names, sizes and times of files; None if there are none."""
    files = list_files(spark, paths)
    return fingerprint(files) if files else None


class Ledger:
    """Stages below one folder, each the current version of a dataset.

    Without ``resume`` every stage runs, and replaces its dataset in one step.
    """

    def __init__(self, spark: SparkSession, root: str, resume: bool = False):
        self.spark, self.root, self.resume = spark, root.rstrip("/"), resume

    def stage(self, name: str, inputs: Sequence, build: Callable[[], DataFrame],
              partition_by: Iterable[str] = (), check: Callable[[DataFrame], object] | None = None,
              buckets: Buckets | None = None) -> Version:
        """The finished stage ``name``; ``build`` is only called if its inputs changed or it was not finished.

        ``inputs`` are fingerprints and other JSON values that the rows depend on. If one is
        None, the stage runs every time.
        """
        parts = list(partition_by)
        mark = fingerprint(name, parts, str(buckets), *inputs)
        if self.resume and mark is not None:
            done = current(self.spark, f"{self.root}/{name}")
            if done is not None and done.fingerprint == mark:
                return done
        return publish(build(), f"{self.root}/{name}", parts, mark, check, buckets)
