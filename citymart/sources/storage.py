"""Folders and files through the Hadoop file system, so any storage Spark can read works."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    path: str
    is_dir: bool
    length: int
    modified: datetime


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    return fs.exists(where)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """The direct content of a folder by name; one metadata call."""
    fs, where = filesystem(spark, path)
    found = [
        Entry(
            s.getPath().getName(),
            s.getPath().toString(),
            s.isDirectory(),
            s.getLen(),
            datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc),
        )
        for s in fs.listStatus(where)
    ]
    return sorted(found)


def head(spark: SparkSession, path: str, size: int = 65_536) -> str:
    """The text at the beginning of a file: at most ``size`` bytes are read, whatever its length."""
    fs, where = filesystem(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8-sig", "ignore")
    finally:
        stream.close()


def is_hidden(name: str) -> bool:
    """Whether Spark's readers pass over an entry of this name."""
    return name.startswith(("_", "."))


def file_count(spark: SparkSession, path: str) -> int:
    """Files directly in a folder, counted as the file system lists them, without an object for each."""
    fs, where = filesystem(spark, path)
    listed, count = fs.listFiles(where, False), 0
    while listed.hasNext():
        listed.next()
        count += 1
    return count
