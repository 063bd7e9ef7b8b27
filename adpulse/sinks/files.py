"""Directory housekeeping through the file system the path belongs to."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _entries(spark: SparkSession, path: str) -> Iterator:
    """What lies in a directory, hidden names left out; nothing when it is not there."""
    files, target = _locate(spark, path)
    if files.exists(target):
        listing = files.listStatusIterator(target)
        while listing.hasNext():
            entry = listing.next()
            if entry.getPath().getName()[0] not in "._":
                yield entry


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _locate(spark, path)
    return files.exists(target)


def make_temporary(spark: SparkSession, path: str) -> None:
    """Create a directory that goes away, with all in it, when the session's process ends."""
    files, target = _locate(spark, path)
    files.mkdirs(target)
    files.deleteOnExit(target)


def make_dir(spark: SparkSession, path: str) -> None:
    files, target = _locate(spark, path)
    files.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory if it is there."""
    files, target = _locate(spark, path)
    files.delete(target, True)


def rename(spark: SparkSession, path: str, other: str) -> None:
    files, target = _locate(spark, path)
    if not files.rename(target, _locate(spark, other)[1]):
        raise OSError(f"{path} cannot become {other}")


def numbered_dirs(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N for which a directory ``name=N`` exists, in order."""
    entries = [entry.getPath().getName() for entry in _entries(spark, path)]
    return sorted(int(entry.split("=")[1]) for entry in entries if entry.startswith(f"{name}="))


def a_file_of_each(spark: SparkSession, path: str) -> dict[str, str]:
    """One file of every directory at or below ``path`` that holds files."""
    found: dict[str, str] = {}
    for entry in _entries(spark, path):
        below = entry.getPath().toString()
        if entry.isDirectory():
            found.update(a_file_of_each(spark, below))
        else:
            found[path] = below
            break
    return found
