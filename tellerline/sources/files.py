"""The few file-system calls Spark's writers have no option for."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _locate(spark, path)
    return fs.exists(hadoop_path)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, hadoop_path = _locate(spark, pattern)
    return [str(status.getPath().toString()) for status in fs.globStatus(hadoop_path) or ()]


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a glob pattern."""
    return bool(listed(spark, pattern))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _locate(spark, path)
    fs.mkdirs(hadoop_path)


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _locate(spark, path)
    fs.create(hadoop_path, True).close()


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _locate(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target's parent is made if need be."""
    fs, hadoop_path = _locate(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(hadoop_path, goal):
        raise OSError(f"cannot move {source} to {target}")


def move_if_there(spark: SparkSession, source: str, target: str) -> bool:
    """``move``, unless the source is gone or goes meanwhile; whether it was moved here."""
    try:
        move(spark, source, target)
    except Exception:
        if exists(spark, source):
            raise
        return False
    return True


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless there is one; whether it was made."""
    fs, hadoop_path = _locate(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError:
        if fs.exists(hadoop_path):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def freshen(spark: SparkSession, path: str) -> None:
    """Set a file's time to now."""
    fs, hadoop_path = _locate(spark, path)
    fs.setTimes(hadoop_path, int(time.time() * 1000), -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all."""
    fs, hadoop_path = _locate(spark, f"{path}.new")
    out = fs.create(hadoop_path, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)
    move(spark, f"{path}.new", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _locate(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since the file was written, or None if it is not there."""
    fs, hadoop_path = _locate(spark, path)
    if not fs.exists(hadoop_path):
        return None
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000
