"""Loading the star schema from the relational tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.functions.snapshots import ALL, Snapshot, Tables, at_snapshot, many_snapshots, or_newest
from tramline.operators import dimensional, quality
from tramline.sources import versions
from tramline.sources.listing import file_system, newest_stored_snapshot
from tramline.sources.tables import (
    read_table,
    read_table_or_none,
    stage_snapshots,
    swap_snapshots,
)

CONTROL_SCHEMA = "name STRING, highest BIGINT"
STAR = tuple(dimensional.KEYS)
# Natural keys that must be unique before a load, as the star's constraints demand.
AUDITED = ("routes", "stops", "calendar", "trips")


def newest(trips: DataFrame):
    """``MAX(snapshot_date)`` of the trips; an error when there are none."""
    date = trips.agg(F.max("snapshot_date")).first()[0]
    if date is None:
        raise RuntimeError("there are no trips to load a star schema from")
    return date


def highest_keys(spark: SparkSession, root: str) -> dict[str, int]:
    """The highest surrogate key given out per table: one small row per load and table.

    A table from before the control table is looked through once.
    """
    control = f"{root}/control"
    system, target = file_system(spark, control)
    known: dict[str, int] = {}
    if system.exists(target):
        rows = spark.read.schema(CONTROL_SCHEMA).json(control).groupBy("name").agg(F.max("highest"))
        known = {name: highest for name, highest in rows.collect()}
    for name in STAR:
        if name not in known:
            before = read_table_or_none(spark, f"{root}/{name}")
            found = before and before.agg(F.max(dimensional.KEYS[name][0])).first()[0]
            known[name] = found or 0
    return known


def load_star(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    snapshot: Snapshot = None,
    audit: bool = True,
) -> DataFrame:
    """Load dimensions and facts of one snapshot (default: the newest); returns the report.

    ``ALL`` loads every stored snapshot in one pass. All five tables are written
    next to the star and swapped in at the end by renaming folders: a load that
    fails before leaves the star as it was. Facts get new keys on every load and
    dimensions keep theirs. No stored fact is read: keys go on from the control
    table, which is written before the swap, so no key is given out twice.
    """
    root = root.rstrip("/")
    chosen, scoped = _scope(tables, snapshot, audit)
    above = highest_keys(spark, root)
    staging = f"{root}/.load-{uuid.uuid4().hex}"

    def stage(name: str, rows: DataFrame) -> DataFrame:
        stage_snapshots(rows, f"{staging}/{name}", chosen)
        return read_table(spark, f"{staging}/{name}")

    _stage_star(scoped, chosen, above, lambda name: read_table_or_none(spark, f"{root}/{name}"), stage)
    control = spark.createDataFrame(list(above.items()), CONTROL_SCHEMA)
    control.coalesce(1).write.mode("append").json(f"{root}/control")
    for name in STAR:
        swap_snapshots(spark, f"{staging}/{name}", f"{root}/{name}", chosen)
    system, target = file_system(spark, staging)
    system.delete(target, True)
    return load_report(spark, root, chosen)


def _scope(tables: dict[str, DataFrame], snapshot: Snapshot, audit: bool) -> tuple[Snapshot, dict[str, DataFrame]]:
    """The snapshot to load, and the tables at it, their keys checked."""
    last = or_newest(None, tables, "trips") or newest(tables["trips"])
    chosen = snapshot if snapshot is not None else last
    scoped = {name: at_snapshot(df, chosen) for name, df in tables.items()}
    if audit:
        quality.gate(quality.key_audit({n: scoped[n] for n in AUDITED}))
    return chosen, scoped


def _stage_star(
    scoped: dict[str, DataFrame],
    chosen: Snapshot,
    above: dict[str, int],
    stored: Callable[[str], DataFrame | None],
    write: Callable[[str, DataFrame], DataFrame],
) -> None:
    """Write the five tables of a load by ``write``, which returns them as written.

    ``above`` has the highest key given out per table, before and then after.
    """
    # The rows of few snapshots are written where the joins leave them, without one more shuffle.
    backfill = isinstance(chosen, str) and chosen == ALL and many_snapshots(scoped["trips"])

    def stage(name: str, rows: DataFrame) -> DataFrame:
        key, watch = dimensional.KEYS[name][0], Observation()
        # Keys are numbered after the rows are dealt out, so this write must not deal them again.
        out = write(name, rows.observe(watch, F.max(key).alias("highest")))
        above[name] = max(above[name], watch.get["highest"] or 0)
        return out

    staged = {}
    for name, rows in dimensional.DIMENSION_ROWS.items():
        before = stored(name)
        scope = None if before is None else at_snapshot(before, chosen)
        key, natural = dimensional.KEYS[name]
        merged = dimensional.upsert(scope, rows(scoped), key, natural, above[name], backfill)
        staged[name] = stage(name, merged)
    trips = dimensional.trip_facts(scoped["trips"], staged["dim_route"], staged["dim_service"])
    staged["fact_trip"] = stage("fact_trip", _numbered(trips, "fact_trip", above, backfill))
    calls = dimensional.stop_time_facts(scoped["stop_times"], staged["fact_trip"], staged["dim_stop"], by_trip=True)
    stage("fact_stop_time", _numbered(calls, "fact_stop_time", above, backfill))


def load_star_version(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    snapshot: Snapshot = None,
    audit: bool = True,
) -> DataFrame:
    """``load_star`` as one commit of all five tables; ``versions.open_version`` reads it.

    Readers see the star before the load or after it, at every moment and wherever
    the load ends. The highest keys are part of the version. The same ``root`` must
    not be loaded by ``load_star`` too.
    """
    root = root.rstrip("/")
    chosen, scoped = _scope(tables, snapshot, audit)
    before, staged = versions.find(spark, root), {}
    above = dict.fromkeys(STAR, 0) | before.keys

    def stored(name: str) -> DataFrame | None:
        return versions.read(spark, root, before, name) if name in before.tables else None

    def stage(name: str, rows: DataFrame) -> DataFrame:
        staged[name] = versions.stage(spark, root, name, rows)
        return versions.read(spark, root, versions.Version(tables={name: staged[name]}), name)

    _stage_star(scoped, chosen, above, stored, stage)
    version = versions.publish(spark, root, before, staged, chosen, above)
    facts = {n: at_snapshot(versions.read(spark, root, version, n), chosen) for n in ("fact_trip", "fact_stop_time")}
    return quality.row_counts(facts)


def _numbered(rows: DataFrame, name: str, above: dict[str, int], backfill: bool) -> DataFrame:
    key = dimensional.KEYS[name][0]
    rows = dimensional.gathered(rows, backfill)
    return rows.withColumn(key, dimensional.next_key(above[name])).select(key, *rows.columns)


def load_report(spark: SparkSession, root: str, snapshot: Snapshot = ALL) -> DataFrame:
    """Rows per fact of the loaded snapshot, from the written tables."""
    return quality.row_counts(
        {
            name: at_snapshot(read_table(spark, f"{root.rstrip('/')}/{name}"), snapshot)
            for name in ("fact_trip", "fact_stop_time")
        }
    )


def newest_dates(spark: SparkSession, root: str, names: Iterable[str] = STAR) -> dict:
    """The newest snapshot of each table, from one listing of its folders."""
    return {n: newest_stored_snapshot(spark, f"{root.rstrip('/')}/{n}") for n in names}


def open_tables(
    spark: SparkSession, root: str, names: Iterable[str], snapshot: Snapshot = ALL
) -> Tables:
    """Tables below ``root``, over the whole history or one snapshot."""
    names = tuple(names)
    opened = {
        name: at_snapshot(read_table(spark, f"{root.rstrip('/')}/{name}"), snapshot)
        for name in names
    }
    return Tables(opened, newest_dates(spark, root, names))


def open_star(spark: SparkSession, root: str, snapshot: Snapshot = ALL) -> Tables:
    return open_tables(spark, root, STAR, snapshot)
