"""Closed days of streamed arrivals, merged into few files.

The streaming query writes a folder for each day, query and batch. ``compact`` moves
days that are over into a versioned table of large files. The commit that shows the
merged rows also records which batches of which day they came from, so from that
moment readers take a merged batch from the merged files only: its old folder no
longer counts, and neither does a replay that writes the folder again. Rows that come
late, in batches that were not merged, count as they are until the next run adds them.

``sweep`` deletes folders of merged batches. It is a step of its own, to be run when
queries planned before the compaction have ended.

Rows without a day stay where they are. Listing is one request for each day, query
and level; rows are read once, when their day is merged or gets late rows.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.sources import versions
from tramline.sources.listing import entries, file_system, subfolders

TABLE = "arrivals"
DAY = r"event_date=(\d{4}-\d{2}-\d{2})"

Runs = list[list[int]]  # first and last numbers of runs of batches
Merged = dict[str, dict[str, Runs]]  # day: query: runs


def runs(batches: set[int]) -> Runs:
    out: Runs = []
    for b in sorted(batches):
        if out and b == out[-1][1] + 1:
            out[-1][1] = b
        else:
            out.append([b, b])
    return out


def _join(known: Runs, new: Runs) -> Runs:
    out: Runs = []
    for lo, hi in sorted([*known, *new]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _days(spark: SparkSession, path: str) -> list[str]:
    try:
        found = (re.fullmatch(DAY, name) for name in subfolders(spark, path))
    except FileNotFoundError:
        return []
    return sorted(m.group(1) for m in found if m)


def _batches(spark: SparkSession, path: str, day: str) -> dict[str, set[int]]:
    """Batches with a folder, per query, of one day."""
    folder = f"{path}/event_date={day}"
    queries = [n for n in subfolders(spark, folder) if n.startswith("query_id=")]
    return {
        q.split("=", 1)[1]: {int(n.split("=")[1]) for n in subfolders(spark, f"{folder}/{q}") if n.startswith("batch_id=")}
        for q in queries
    }


def _within(merged: Merged) -> Column:
    """Rows of the given batches; a filter on partition columns alone."""
    of = [
        (F.col("event_date") == F.lit(day).cast("date"))
        & (F.col("query_id") == query)
        & F.col("batch_id").between(lo, hi)
        for day, queries in merged.items()
        for query, held in queries.items()
        for lo, hi in held
    ]
    return F.coalesce(reduce(or_, of, F.lit(False)), F.lit(False))


def _open_rows(spark: SparkSession, path: str) -> DataFrame:
    """The folders of the streaming query; their file index is asked anew each time."""
    rows = spark.read.parquet(path)
    kinds = {"event_date": "date", "query_id": "string", "batch_id": "bigint"}
    return rows.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


def _closed_rows(spark: SparkSession, root: str, version: versions.Version) -> DataFrame:
    return versions.read(spark, root, version, TABLE).withColumnRenamed("snapshot_date", "event_date")


def _has_rows(spark: SparkSession, path: str) -> bool:
    try:
        return any(n.startswith("event_date=") for n, *_ in entries(spark, path))
    except FileNotFoundError:
        return False


def read_arrivals(spark: SparkSession, path: str, root: str) -> DataFrame:
    """All arrivals, each once: merged days below ``root``, the rest from the query's own folders below ``path``."""
    path = path.rstrip("/")
    version = versions.find(spark, root)
    parts = [_closed_rows(spark, root, version)] if TABLE in version.tables else []
    if _has_rows(spark, path) or not parts:
        merged, still = version.notes.get(TABLE, {}), set(_days(spark, path))
        rows = _open_rows(spark, path)
        left = {day: queries for day, queries in merged.items() if day in still}
        parts.append(rows.where(~_within(left)) if left else rows)
    return reduce(lambda a, b: a.unionByName(b), parts)


def compact(spark: SparkSession, path: str, root: str, before: dt.date | str) -> list[str]:
    """Merge all batches of the days before a date that were not merged yet; returns these days.

    A day that was merged already is written again with its late rows. Only one run
    at a time wins: another fails with ``VersionConflict`` and has changed nothing.
    """
    path = path.rstrip("/")
    version = versions.find(spark, root)
    known: Merged = version.notes.get(TABLE, {})
    new: Merged = {}
    for day in _days(spark, path):
        if day >= str(before):
            break
        for query, batches in _batches(spark, path, day).items():
            held = known.get(day, {}).get(query, [])
            fresh = {b for b in batches if not any(lo <= b <= hi for lo, hi in held)}
            if fresh:
                new.setdefault(day, {})[query] = runs(fresh)
    if not new:
        return []
    rows = _open_rows(spark, path).where(_within(new))
    if TABLE in version.tables:
        days = [F.lit(day).cast("date") for day in new]
        stored = _closed_rows(spark, root, version).where(F.col("event_date").isin(*days))
        rows = rows.unionByName(stored)
    staged = versions.stage(spark, root, TABLE, rows.withColumnRenamed("event_date", "snapshot_date"), balance=True)
    merged = known | {
        day: known.get(day, {}) | {q: _join(known.get(day, {}).get(q, []), held) for q, held in queries.items()}
        for day, queries in new.items()
    }
    versions.publish(spark, root, version, {TABLE: staged}, notes={TABLE: merged})
    return sorted(new)


def sweep(spark: SparkSession, path: str, root: str) -> int:
    """Delete the folders of merged batches; returns their number."""
    path, gone = path.rstrip("/"), 0
    merged: Merged = versions.find(spark, root).notes.get(TABLE, {})
    for day in _days(spark, path):
        if day not in merged:
            continue
        folder = f"{path}/event_date={day}"
        for query, batches in _batches(spark, path, day).items():
            held = merged[day].get(query, [])
            old = {b for b in batches if any(lo <= b <= hi for lo, hi in held)}
            for b in sorted(old):
                system, target = file_system(spark, f"{folder}/query_id={query}/batch_id={b}")
                system.delete(target, True)
            gone += len(old)
            _drop_if_empty(spark, f"{folder}/query_id={query}")
        _drop_if_empty(spark, folder)
    return gone


def _drop_if_empty(spark: SparkSession, folder: str) -> None:
    if not entries(spark, folder):
        system, target = file_system(spark, folder)
        system.delete(target, False)
