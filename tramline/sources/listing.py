"""Snapshot discovery from folder names, one level at a time, on any file system."""

from __future__ import annotations

import datetime as dt
import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

EMPTY_MARK = "_EMPTY"


class SnapshotNotFound(FileNotFoundError):
    """No usable snapshot below the given root."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def entries(spark: SparkSession, folder: str) -> list[tuple[str, bool, int]]:
    """``(name, is a folder, bytes)`` of what lies directly in a folder.

    One listing request, however much lies below. A missing folder is a
    ``FileNotFoundError``; other failures of the storage stay what they are.
    """
    system, target = file_system(spark, folder)
    try:
        found = system.listStatus(target)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() == "java.io.FileNotFoundException":
            raise FileNotFoundError(folder) from error
        raise
    return [(s.getPath().getName(), s.isDirectory(), s.getLen()) for s in found]


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    return [name for name, is_folder, _ in entries(spark, folder) if is_folder]


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``root``.

    Only the listing is used; file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def _qualified(spark: SparkSession, path: str) -> str:
    system, target = file_system(spark, path)
    return system.makeQualified(target).toString()


def _newest_first(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Folder names that match, newest first; numbers are compared as numbers."""
    try:
        names = [n for n in subfolders(spark, root) if re.fullmatch(pattern, n)]
    except FileNotFoundError as error:
        raise SnapshotNotFound(f"cannot list {root}") from error
    return sorted(names, key=lambda n: [int(x) for x in re.findall(r"\d+", n)], reverse=True)


def _date(*parts: str) -> dt.date | None:
    try:
        return dt.date(*map(int, parts))
    except ValueError:
        return None


def latest_raw_snapshot(spark: SparkSession, root: str) -> tuple[dt.date, str]:
    """The newest ``<root>/<yyyy-mm-dd>/extracted`` with anything in it: date and folder.

    Dates are tried from the newest on, so old snapshots are never listed.
    """
    root = root.rstrip("/")
    for name in _newest_first(spark, root, r"\d{4}-\d{2}-\d{2}"):
        date, folder = _date(*name.split("-")), f"{root}/{name}/extracted"
        if date and "extracted" in subfolders(spark, f"{root}/{name}") and entries(spark, folder):
            return date, _qualified(spark, folder)
    raise SnapshotNotFound(f"no <date>/extracted folder below {root}")


def latest_processed_snapshot(spark: SparkSession, root: str) -> tuple[dt.date, str]:
    """The newest ``year=/month=/day=`` folder with a dataset in it, level by level."""
    root = root.rstrip("/")
    for year in _newest_first(spark, root, r"year=\d+"):
        for month in _newest_first(spark, f"{root}/{year}", r"month=\d+"):
            for day in _newest_first(spark, f"{root}/{year}/{month}", r"day=\d+"):
                date = _date(*(x.split("=")[1] for x in (year, month, day)))
                folder = f"{root}/{year}/{month}/{day}"
                if date and subfolders(spark, folder):
                    return date, _qualified(spark, folder)
    raise SnapshotNotFound(f"no processed snapshot below {root}")


def stored_snapshots(spark: SparkSession, table: str) -> list[dt.date]:
    """The snapshots of a partitioned table, newest first, by the names of its folders."""
    try:
        names = _newest_first(spark, table, r"snapshot_date=\d{4}-\d{2}-\d{2}")
    except SnapshotNotFound:
        return []
    return [dt.date.fromisoformat(n.split("=")[1]) for n in names]


def newest_stored_snapshot(spark: SparkSession, table: str) -> dt.date | None:
    """The newest snapshot that has rows; one replaced by nothing is marked and passed over."""
    for date in stored_snapshots(spark, table):
        if EMPTY_MARK not in {n for n, *_ in entries(spark, f"{table}/snapshot_date={date}")}:
            return date
    return None


def is_missing(error: AnalysisException) -> bool:
    """Whether there is nothing to read, as opposed to any other failure."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
