"""Choosing one snapshot of a history table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "all"
FEW = 32  # snapshots of which each task may write a file of its own
Snapshot = dt.date | str | Column | None


class Tables(dict):
    """Tables by name, with the newest stored snapshot of each where it is known.

    The dates come from the names of partition folders, so that queries on the
    newest snapshot name it and never look through the history for it.
    """

    def __init__(self, tables: dict[str, DataFrame], newest: dict[str, dt.date | None]):
        super().__init__(tables)
        self.newest = newest


def or_newest(snapshot: Snapshot, tables: dict[str, DataFrame], name: str) -> Snapshot:
    """The given snapshot, or the newest one of a table if its date is known."""
    return getattr(tables, "newest", {}).get(name) if snapshot is None else snapshot


def latest_snapshot(df: DataFrame) -> Column:
    """``MAX(snapshot_date)`` as an uncorrelated scalar subquery.

    On a table partitioned by ``snapshot_date`` the filter built from it prunes
    partitions at run time, without a driver round trip.
    """
    return df.select(F.max("snapshot_date")).scalar()


def many_snapshots(df: DataFrame) -> bool:
    """Whether a frame has so many snapshots that its rows are to be gathered by them before they are written."""
    return df.select("snapshot_date").distinct().limit(FEW + 1).count() > FEW


def at_snapshot(
    df: DataFrame, snapshot: Snapshot = None, of: DataFrame | None = None
) -> DataFrame:
    """Rows of one snapshot: the given date, or the newest one in ``of`` (or ``df``).

    ``ALL`` keeps the whole history.
    """
    if isinstance(snapshot, str) and snapshot == ALL:
        return df
    if snapshot is None:
        snapshot = latest_snapshot(df if of is None else of)
    elif not isinstance(snapshot, Column):
        snapshot = F.lit(snapshot).cast("date")
    return df.where(F.col("snapshot_date") == snapshot)
