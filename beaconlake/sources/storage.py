"""File-system helpers over Hadoop's FileSystem, so that any cluster storage works."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DELETERS = 16


class AlreadyThere(OSError):
    pass


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _path(spark, pattern)
    found = fs.globStatus(p)
    return sorted(str(status.getPath()) for status in (found or []))


def matching_times(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Matching paths and when each was last changed, in seconds since 1970: one listing."""
    fs, p = _path(spark, pattern)
    return sorted((str(status.getPath()), status.getModificationTime() / 1000)
                  for status in (fs.globStatus(p) or []))


def matching_sizes(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Matching paths and their bytes: one listing."""
    fs, p = _path(spark, pattern)
    return sorted((str(status.getPath()), status.getLen()) for status in (fs.globStatus(p) or []))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def delete_all(spark: SparkSession, paths: Sequence[str]) -> None:
    """Several at a time; the session waits for the store, not for a turn."""
    if paths:
        with ThreadPoolExecutor(DELETERS) as pool:
            list(pool.map(inheritable_thread_target(spark)(lambda path: delete(spark, path)), paths))


def delete_if_empty(spark: SparkSession, path: str) -> bool:
    """Delete a folder with nothing but Spark's success marker in it."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return True
    if any(status.getPath().getName() != "_SUCCESS" for status in fs.listStatus(p)):
        return False
    return fs.delete(p, True)


def modified(spark: SparkSession, path: str) -> float:
    """When the path was last changed, in seconds since 1970."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def from_uri(spark: SparkSession, uri: str) -> str:
    """Plain path of an escaped one, as `_metadata.file_path` gives it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _path(spark, source)
    _, q = _path(spark, target)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def rename_all(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> None:
    """(source, target) pairs, several at a time."""
    if pairs:
        with ThreadPoolExecutor(DELETERS) as pool:
            list(pool.map(inheritable_thread_target(spark)(
                lambda pair: rename(spark, *pair)), pairs))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small text file; fails when it exists."""
    fs, p = _path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """A new small file that is there whole or not at all; of several writers one makes it, the
    others get AlreadyThere. A hidden file is written first and given its name by an operation
    that refuses a name that is taken: a link on a local disk, a rename elsewhere. A store whose
    rename is a copy needs one writer at a time."""
    fs, target = _path(spark, path)
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    fs.mkdirs(target.getParent())
    write_text(spark, hidden, text)
    try:
        if fs.getScheme() == "file":
            try:
                os.link(*(_path(spark, p)[1].toUri().getPath() for p in (hidden, path)))
            except FileExistsError as error:
                raise AlreadyThere(path) from error
        elif fs.exists(target) or not fs.rename(_path(spark, hidden)[1], target):
            raise AlreadyThere(path)
    finally:
        fs.delete(_path(spark, hidden)[1], False)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
