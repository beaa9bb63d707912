"""Tables published in versions that never change, and a log of commits that names what is current.

    path/data/<unique>/<table>/...    a table as it was written once
    path/commits/<number>.json        which folder each table of that version has

A version becomes visible when its commit file gets its name, in one step: the file is written under another name and then linked
or renamed to a number that must not be taken. So readers see all tables of one version or of another, never a mix, and no folder is
renamed. Tables that a publish doesn't name stay as they are.

Two writers: both write their data, and the one that takes the next number first is first. The other reads that commit and takes the number after
it: of the tables that both wrote its own are current then. A writer that gives ``expected``, the version it started from,
gets ``Conflict`` instead if another one was faster, and nothing of it becomes visible. What a failed writer leaves is never read;
``retire`` removes it with old versions.

The name is taken by a hard link on local disks and by a rename that doesn't overwrite elsewhere, which HDFS does in one step.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has published since the version that was expected."""


class _Folder:
    """Small files of a folder through Hadoop, so that any store that Spark reads will do."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.configuration = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(self.configuration)
        self.path = self.system.makeQualified(self.path)

    def at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path.toString() + "/" + "/".join(names))

    def names(self, folder: str) -> list[str]:
        place = self.at(folder)
        return sorted(s.getPath().getName() for s in self.system.listStatus(place)) if self.system.exists(place) else []

    def read(self, *names: str) -> str:
        stream = self.system.open(self.at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, *names: str) -> None:
        stream = self.system.create(self.at(*names), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def take(self, written: tuple[str, ...], wanted: tuple[str, ...]) -> bool:
        """Give a written file a name that must not be taken; whether it got it."""
        source, target = self.at(*written), self.at(*wanted)
        if source.toUri().getScheme() == "file":
            try:
                os.link(source.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.configuration)
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(source, target, options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, *names: str) -> None:
        self.system.delete(self.at(*names), True)


def _numbers(folder: _Folder) -> list[int]:
    return [int(name[:-5]) for name in folder.names("commits") if name.endswith(".json") and name[:-5].isdigit()]


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the current version; 0 before the first."""
    return max(_numbers(_Folder(spark, path)), default=0)


def _tables(folder: _Folder, version: int) -> dict[str, str]:
    return json.loads(folder.read("commits", f"{version:020d}.json"))["tables"] if version else {}


def publish(tables: dict[str, DataFrame], path: str, expected: int | None = None) -> int:
    """Write tables and make them current together; returns the number of the new version."""
    spark = next(iter(tables.values())).sparkSession
    folder, own = _Folder(spark, path), uuid.uuid4().hex
    for name, table in tables.items():
        table.write.parquet(folder.at("data", own, name).toString())
    mine = {name: f"data/{own}/{name}" for name in tables}
    folder.system.mkdirs(folder.at("commits"))
    while True:
        last = max(_numbers(folder), default=0)
        if expected is not None and last != expected:
            folder.delete("data", own)
            raise Conflict(f"version {last} is current, {expected} was expected")
        draft = ("commits", f".{uuid.uuid4().hex}")
        folder.write(json.dumps({"tables": {**_tables(folder, last), **mine}}), *draft)
        taken = folder.take(draft, ("commits", f"{last + 1:020d}.json"))
        folder.delete(*draft)
        if taken:
            return last + 1


def read_published(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the current version, or of another one that is still kept. Several tables of one version belong together."""
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    version = max(numbers, default=0) if version is None else version
    place = _tables(folder, version).get(name) if version in numbers else None
    if place is None:
        raise FileNotFoundError(f"{path} has no table {name} in version {version}")
    return spark.read.parquet(folder.at(place).toString())


def retire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all but the last ``keep`` versions and the data that none of them names. Not while a writer is at work, whose data no commit names yet."""
    folder = _Folder(spark, path)
    numbers = sorted(_numbers(folder))
    kept = {place.split("/")[1] for number in numbers[-keep:] for place in _tables(folder, number).values()}
    for number in numbers[:-keep]:
        folder.delete("commits", f"{number:020d}.json")
    for name in folder.names("data"):
        if name not in kept:
            folder.delete("data", name)
