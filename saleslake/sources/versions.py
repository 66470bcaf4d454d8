"""Versions of a lake: tables are written beside those in use and taken into use together.

A small file under the base path says in which folder each table lies. New tables go to a folder
never used before, and only when all of them are there is that file replaced, in one step. Until
then, and after a failure, readers find the tables of the version before.
"""

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from saleslake.sources.scratch import file_system, remove

POINTER = "tables.json"
FOLDER = "versions"


@dataclass(frozen=True)
class Tables:
    """Folders by table, under the base path: those in use, and those in use before (kept for
    readers that have already planned on them)."""

    used: dict[str, str] = field(default_factory=dict)
    before: dict[str, str] = field(default_factory=dict)

    def versions(self) -> set[str]:
        return {folder.split("/")[1] for folder in [*self.used.values(), *self.before.values()]}


def in_use(spark: SparkSession, base: str) -> Tables:
    """What the pointer says; nothing where no load has ended yet."""
    files, path = file_system(spark, f"{base}/{POINTER}")
    if not files.exists(path):
        return Tables()
    stream = files.open(path)
    try:
        said = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Tables(said["used"], said["before"])


def take_into_use(spark: SparkSession, base: str, folders: dict[str, str]) -> Tables:
    """Point the given tables to new folders; other tables stay. One load at a time."""
    last = in_use(spark, base)
    now = Tables({**last.used, **folders}, last.used)
    files, path = file_system(spark, f"{base}/{POINTER}")
    files.mkdirs(path.getParent())
    _, beside = file_system(spark, f"{base}/{POINTER}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    try:
        out.write(bytearray(json.dumps({"used": now.used, "before": now.before}, indent=1).encode()))
    finally:
        out.close()
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    qualified = files.makeQualified(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), context._jsc.hadoopConfiguration()).rename(
        files.makeQualified(beside), qualified, options
    )
    return now


@dataclass(frozen=True)
class Version:
    """A version that is being written."""

    base: str
    name: str
    folders: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        """The new folder of a table; asking for it makes the table part of the version."""
        self.folders[table] = f"{FOLDER}/{self.name}/{table}"
        return f"{self.base}/{self.folders[table]}"


@contextmanager
def new_version(spark: SparkSession, base: str) -> Iterator[Version]:
    """Tables written within the block are taken into use together at its end. Should it fail,
    the tables in use stay as they are, and what was written is removed."""
    version = Version(base, uuid.uuid4().hex)
    try:
        yield version
        last = in_use(spark, base)
        now = take_into_use(spark, base, version.folders)
    except BaseException:
        remove(spark, f"{base}/{FOLDER}/{version.name}")
        raise
    for name in last.versions() - now.versions():
        remove(spark, f"{base}/{FOLDER}/{name}")


def remove_unused(spark: SparkSession, base: str) -> list[str]:
    """Remove what loads left that were killed before they could: versions that nothing points to.
    Not to be called while a load runs."""
    kept = in_use(spark, base).versions()
    files, folder = file_system(spark, f"{base}/{FOLDER}")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    for name in names:
        if name not in kept:
            remove(spark, f"{base}/{FOLDER}/{name}")
    return sorted(set(names) - kept)
