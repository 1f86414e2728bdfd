"""File system calls on whatever system the path names (local, HDFS, object store)."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path, or anything the glob pattern matches, exists."""
    fs, hadoop_path = _resolve(spark, path)
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _resolve(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.mkdirs(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def input_root(spark: SparkSession, path: str) -> str:
    """The folder below which a path or glob pattern names its files, as a URI that ends in a slash."""
    cut = min((path.index(c) for c in "*?[{" if c in path), default=len(path))
    folder = path[:cut] if cut == len(path) else path[:cut].rpartition("/")[0] or "."
    fs, hadoop_path = _resolve(spark, folder)
    if fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isFile():
        hadoop_path = hadoop_path.getParent()
    return fs.makeQualified(hadoop_path).toUri().toString().rstrip("/") + "/"


def identity(spark: SparkSession, path: str) -> str:
    """A digest of names, sizes and modification times of the files a path or glob pattern stands for."""
    fs, hadoop_path = _resolve(spark, path)
    found = []
    for match in fs.globStatus(hadoop_path) or []:
        files = fs.listFiles(match.getPath(), True)
        while files.hasNext():
            file = files.next()
            found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join([path, *sorted(found)]).encode()).hexdigest()
