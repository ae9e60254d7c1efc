"""Result tables that survive a failed rerun: snapshots behind a manifest.

A table is a folder.  Every write goes to a fresh snapshot folder under
``data``; once all of it is there, one small file under ``versions``, named by
the next number and created only if it does not exist, publishes it.  Readers
take the highest number whose file is complete.  So a writer that dies leaves
nothing visible, readers of an older snapshot are not disturbed, and of two
writers that finish together each gets a number of its own.  All paths go
through Spark's file systems; nothing is read or written by the driver but the
manifests.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carelens.sources.sinks import write_table

DIGITS = 10


class _Folder:
    """A folder of the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.fs.exists(self.at("")):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at("")))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of that name."""
        from py4j.protocol import Py4JJavaError

        try:
            stream = self.fs.create(self.at(name), False)
        except Py4JJavaError:
            if self.fs.exists(self.at(name)):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _manifests(spark: SparkSession, root: str) -> dict[int, Mapping | None]:
    """Every version's manifest; None for one that was not written to its end."""
    folder, out = _Folder(spark, f"{root}/versions"), {}
    for name in folder.names():
        if name.isdigit():
            try:
                out[int(name)] = json.loads(folder.read(name))
            except ValueError:
                out[int(name)] = None
    return out


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the published versions, oldest first."""
    return sorted(v for v, m in _manifests(spark, root).items() if m)


def publish(df: DataFrame, root: str, fmt: str = "parquet") -> int:
    """Write ``df`` as the next version of the table at ``root``; its number."""
    spark, root = df.sparkSession, root.rstrip("/")
    snapshot = uuid.uuid4().hex
    write_table(df, f"{root}/data/{snapshot}", fmt, mode="errorifexists")
    manifest = json.dumps({"snapshot": snapshot, "format": fmt, "schema": json.loads(df.schema.json())})
    folder = _Folder(spark, f"{root}/versions")
    while True:
        number = max(_manifests(spark, root), default=0) + 1
        if folder.create(f"{number:0{DIGITS}d}", manifest):
            return number


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A published version (default: the latest) with the schema it was written with."""
    root = root.rstrip("/")
    there = {v: m for v, m in _manifests(spark, root).items() if m}
    number = max(there, default=None) if version is None else version
    if number not in there:
        raise FileNotFoundError(f"no version {'' if version is None else version} of {root}")
    m = there[number]
    reader = spark.read.schema(T.StructType.fromJson(m["schema"])).format(m["format"])
    if m["format"] == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{root}/data/{m['snapshot']}")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all snapshots but those of the last ``keep`` versions, with their
    manifests; also those that no manifest names, so no writer may be at work.
    Returns the snapshots deleted."""
    root, there = root.rstrip("/"), _manifests(spark, root)
    last = sorted(v for v, m in there.items() if m)[-keep:]
    held = {there[v]["snapshot"] for v in last}
    manifests, data = _Folder(spark, f"{root}/versions"), _Folder(spark, f"{root}/data")
    # The newest number stays, complete or not: numbers are not used again.
    for v in sorted(there)[:-1]:
        if v not in last:
            manifests.delete(f"{v:0{DIGITS}d}")
    gone = [s for s in data.names() if s not in held]
    for s in gone:
        data.delete(s)
    return gone
