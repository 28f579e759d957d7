"""Moves and removals on the storage that Spark reads, for whole files and folders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark then removes the shuffle files of a write as soon as it is done.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go with each write, so only one step's are on disk at a time."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as file names of this storage are written."""
    files, place = _open(spark, path)
    return files.makeQualified(place).toString()


def folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of last change in seconds) of the folders in ``path``; none if it is missing."""
    files, place = _open(spark, path)
    if not files.exists(place):
        return []
    found = [s for s in files.listStatus(place) if s.isDirectory()]
    return [(s.getPath().getName(), s.getModificationTime() // 1000) for s in found]


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _open(spark, path)
    return files.exists(place)


def publish(spark: SparkSession, made: str, target: str) -> None:
    """Puts the finished folder ``made`` in the place of ``target``, with one move."""
    files, old = _open(spark, made)
    _, new = _open(spark, target)
    files.mkdirs(new.getParent())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"{made} could not be moved to {target}")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a table in a folder, by full name; without folders, markers and hidden files."""
    files, place = _open(spark, path)
    found = [s for s in files.listStatus(place) if not s.isDirectory() and s.getLen()]
    names = [s.getPath().toString() for s in found]
    return sorted(n for n in names if n.rsplit("/", 1)[1][0] not in "._")


def remove(spark: SparkSession, paths: Iterable[str]) -> int:
    """Removes folders with all they hold; the number removed."""
    done = 0
    for path in paths:
        files, place = _open(spark, path)
        done += bool(files.delete(place, True))
    return done
