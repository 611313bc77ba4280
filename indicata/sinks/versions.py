"""K4/J5 — a partitioned table whose changes touch only changed partitions.

Layout under the table's root::

    data/<version folder>/<partition column>=<value>/part-….parquet
    versions/00000012.json      which folder holds each partition, and the schema

A change writes the partitions it touches into a new version folder, then adds
the next version file; readers take the highest one.  That file appears whole,
by one rename that fails if another writer was faster: until then the table is
as it was, and a killed change leaves only a folder that no version names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indicata.operators.joins import upsert
from indicata.session import scratch_path


class ConflictError(RuntimeError):
    """Another change was published in the meantime."""


@dataclass
class Version:
    number: int
    schema: T.StructType
    partition_by: list[str]
    folders: dict[str, str]      # "column=value/…" as Spark names it -> version folder under data/


class _Files:
    """The few file operations that the driver needs, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = self.path(root)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))

    def children(self, path) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def partitions(self, path, depth: int) -> list[str]:
        """Partition folders, by their names from ``path`` on."""
        found = [x for x in self.children(path) if "=" in x]
        if depth == 1:
            return found
        return [f"{x}/{y}" for x in found for y in self.partitions(self.path(path.toString(), x), depth - 1)]

    def read(self, path) -> str:
        stream = self.fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, path) -> None:
        """The file appears whole or not at all, and never replaces another."""
        draft = self.path(path.getParent().toString(), f".draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        plain = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(plain.NONE.getClass(), 0)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(path), none)
        except Exception as failed:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(failed):
                raise ConflictError(f"{path.getName()} was published by another change") from failed
            raise


def current(spark: SparkSession, root: str) -> Version | None:
    """The highest published version."""
    files = _Files(spark, root)
    names = [x for x in files.children(files.path(root, "versions")) if x.endswith(".json") and x[0] != "."]
    if not names:
        return None
    told = json.loads(files.read(files.path(root, "versions", max(names))))
    return Version(int(max(names)[:-5]), T.StructType.fromJson(told["schema"]), told["partition_by"], told["folders"])


def read(spark: SparkSession, root: str, version: Version | None = None,
         partitions: list[str] | None = None) -> DataFrame:
    """The table (or some of its partitions) as of a version: only folders that it names are listed or scanned, and
    filters on partition columns prune among them."""
    version = version or current(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version under {root}")
    by_folder: dict[str, list[str]] = {}
    for name, folder in version.folders.items():
        if partitions is None or name in partitions:
            by_folder.setdefault(folder, []).append(f"{root}/data/{folder}/{name}")
    parts = [spark.read.schema(version.schema).option("basePath", f"{root}/data/{folder}").parquet(*sorted(paths))
             for folder, paths in sorted(by_folder.items())]
    names = [f"`{x}`" for x in version.schema.names]
    if not parts:
        return spark.createDataFrame([], version.schema)
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])


def _write(df: DataFrame, root: str, partition_by: list[str], files: _Files) -> dict[str, str]:
    """A new version folder, and the partitions it holds."""
    folder = f"v-{uuid.uuid4().hex}"
    path = f"{root}/data/{folder}"
    df.write.partitionBy(*partition_by).parquet(path)
    return {name: folder for name in files.partitions(files.path(path), len(partition_by))}


def _publish(files: _Files, root: str, version: Version) -> Version:
    text = json.dumps({"schema": version.schema.jsonValue(), "partition_by": version.partition_by,
                       "folders": version.folders})
    files.publish(text, files.path(root, "versions", f"{version.number:08d}.json"))
    return version


def overwrite(df: DataFrame, root: str, partition_by: list[str]) -> Version:
    """The whole table anew, as the next version."""
    spark = df.sparkSession
    files, before = _Files(spark, root), current(spark, root)
    columns = [*[c for c in df.columns if c not in partition_by], *partition_by]
    schema = T.StructType([df.schema[c] for c in columns])
    folders = _write(df.select(*[f"`{c}`" for c in columns]), root, partition_by, files)
    return _publish(files, root, Version(1 + (before.number if before else 0), schema, partition_by, folders))


def _staged(updates: DataFrame, before: Version) -> tuple[DataFrame, list[str]]:
    """The updates, written once by partition, and the partitions that they touch."""
    spark, path = updates.sparkSession, scratch_path(updates.sparkSession, "merge-updates")
    names = [f"`{c}`" for c in before.schema.names]
    updates.select(*names).write.partitionBy(*before.partition_by).parquet(path)
    files = _Files(spark, path)
    touched = files.partitions(files.root, len(before.partition_by))
    return spark.read.schema(before.schema).parquet(path).select(*names), touched


def merge(updates: DataFrame, root: str, keys: list[str]) -> Version:
    """Upsert into the partitions that ``updates`` touch; all others are neither read nor written.

    ``keys`` must hold the partition columns: a key that could move to another
    partition would leave its old row behind.  A key with two updates fails
    the change (see ``upsert``); so does another change published meanwhile."""
    spark = updates.sparkSession
    files, before = _Files(spark, root), current(spark, root)
    if before is None:
        raise FileNotFoundError(f"no published version under {root}")
    if not set(before.partition_by) <= set(keys):
        raise ValueError(f"keys {keys} don't tell the partition ({before.partition_by})")
    updates, touched = _staged(updates, before)
    if not touched:
        return before
    merged = upsert(read(spark, root, before, touched), updates, keys)
    return _swap(files, root, before, merged)


def replace(df: DataFrame, root: str) -> Version:
    """Truncate and load of the partitions that ``df`` has rows of; the others stay as they are."""
    spark = df.sparkSession
    files, before = _Files(spark, root), current(spark, root)
    if before is None:
        raise FileNotFoundError(f"no published version under {root}")
    return _swap(files, root, before, df)


def _swap(files: _Files, root: str, before: Version, df: DataFrame) -> Version:
    """Write partitions whole into a new folder, then publish the version in which they take the place of the old."""
    new = _write(df.select(*[f"`{c}`" for c in before.schema.names]), root, before.partition_by, files)
    return _publish(files, root, Version(before.number + 1, before.schema, before.partition_by, before.folders | new))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete version folders that none of the last ``keep`` versions names, and version files before these.  Not to be
    run beside a change, whose folder no version names yet."""
    files = _Files(spark, root)
    at = files.path(root, "versions")
    names = sorted(x for x in files.children(at) if x.endswith(".json") and x[0] != ".")
    used = set()
    for name in names[-keep:]:
        used |= set(json.loads(files.read(files.path(root, "versions", name)))["folders"].values())
    for name in names[:-keep]:
        files.fs.delete(files.path(root, "versions", name), False)
    gone = [x for x in files.children(files.path(root, "data")) if x not in used]
    for folder in gone:
        files.fs.delete(files.path(root, "data", folder), True)
    return gone
