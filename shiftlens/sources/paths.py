"""Listing and peeking at files of any Hadoop-compatible store."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: What comes before the path proper in the name of a file.
STORE = r"^[^/:]+:(//[^/]*)?"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def local_part(path: str) -> str:
    """A path without its store."""
    return re.sub(STORE, "", path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path in full, without its store."""
    fs, p = _open(spark, path)
    return local_part(fs.makeQualified(p).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, sorted; empty when the folder does not exist."""
    fs, p = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def walk(spark: SparkSession, root: str) -> list[str]:
    """All files below a folder."""
    fs, p = _open(spark, root)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)
