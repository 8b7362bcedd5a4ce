"""Commits of several tables at once.

Data files are written to folders of their own and never changed or moved:
``<root>/<table>/load_id=<id>/snapshot_date=<date>/``. A version of all tables is one
small manifest, ``<root>/_versions/<number>.json``: for each table its columns and, for
each snapshot, the load that holds it. A load becomes visible when its manifest gets
its number, by one rename that never replaces a file. So a reader sees all of a load
or nothing of it, keeps its version however many loads follow, and of two loads that
began on the same version the second fails instead of undoing the first.

The newest version is the highest number in one listing. Manifests grow with tables
and snapshots, not with rows. ``expire`` is the only step that deletes.

The rename is atomic on HDFS. The local file system, meant for tests, looks for the
name and then renames; stores without rename need a client that offers it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline.functions.snapshots import ALL, Snapshot, Tables, at_snapshot
from tramline.sources.listing import entries, file_system, subfolders

MANIFESTS = "_versions"


class VersionConflict(RuntimeError):
    """Another load was committed since this one began."""


@dataclass(frozen=True)
class Table:
    """What a version knows of one table."""

    schema: str  # the columns as Spark writes them in JSON, with the snapshot
    loads: dict[str, str] = field(default_factory=dict)  # snapshot: load


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    keys: dict[str, int] = field(default_factory=dict)  # table: highest surrogate key given out
    notes: dict = field(default_factory=dict)  # what else a commit records, by table
    def text(self) -> str:
        tables = {n: {"schema": t.schema, "loads": t.loads} for n, t in self.tables.items()}
        return json.dumps({"tables": tables, "keys": self.keys, "notes": self.notes})

    @staticmethod
    def parse(number: int, text: str) -> Version:
        held = json.loads(text)
        tables = {n: Table(**t) for n, t in held["tables"].items()}
        return Version(number, tables, held["keys"], held.get("notes", {}))


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    try:
        found = entries(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    except FileNotFoundError:
        return []
    stems = (name.removesuffix(".json") for name, *_ in found if name.endswith(".json"))
    return sorted(int(stem) for stem in stems if stem.isdigit())


def find(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The version of that number, or the newest; version 0, without tables, before the first."""
    if number is None:
        number = max(numbers(spark, root), default=0)
    if number == 0:
        return Version()
    system, target = file_system(spark, _manifest(root, number))
    stream = system.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version.parse(number, text)


def read(spark: SparkSession, root: str, version: Version, name: str) -> DataFrame:
    """One table as the version has it, snapshots pruned by folder."""
    table = version.tables[name]
    schema = StructType.fromJson(json.loads(table.schema))
    base = f"{root.rstrip('/')}/{name}"
    folders = [f"{base}/load_id={load}/snapshot_date={date}" for date, load in sorted(table.loads.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.names)


def open_version(
    spark: SparkSession, root: str, snapshot: Snapshot = ALL, number: int | None = None
) -> Tables:
    """All tables of one version, over their history or at one snapshot."""
    version = find(spark, root, number)
    opened = {n: at_snapshot(read(spark, root, version, n), snapshot) for n in version.tables}
    dates = {n: max(map(dt.date.fromisoformat, t.loads), default=None) for n, t in version.tables.items()}
    return Tables(opened, dates)


def stage(spark: SparkSession, root: str, name: str, rows: DataFrame, balance: bool = False) -> Table:
    """Write rows by snapshot to a folder that no version names yet.

    ``balance`` spreads a frame of many snapshots so that each file belongs to one.
    """
    load = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/{name}/load_id={load}"
    dealt = rows.hint("rebalance", "snapshot_date") if balance else rows
    dealt.write.partitionBy("snapshot_date").parquet(folder)
    dates = (n.split("=")[1] for n in subfolders(spark, folder) if n.startswith("snapshot_date="))
    names = [c for c in rows.columns if c != "snapshot_date"]
    schema = rows.select(*names, F.col("snapshot_date").cast("date")).schema.json()
    return Table(schema, dict.fromkeys(dates, load))


def publish(
    spark: SparkSession,
    root: str,
    before: Version,
    staged: dict[str, Table],
    snapshot: Snapshot = None,
    keys: dict[str, int] | None = None,
    notes: dict | None = None,
) -> Version:
    """Make staged tables the next version after ``before``.

    Staged snapshots replace stored ones of their table. A date given as ``snapshot``
    is replaced even by nothing, ``ALL`` replaces all of them. Tables that were not
    staged stay. ``VersionConflict`` if ``before`` is no longer the newest.
    """
    whole = isinstance(snapshot, str) and snapshot == ALL
    tables = dict(before.tables)
    for name, table in staged.items():
        old = tables[name].loads if name in tables and not whole else {}
        kept = {d: load for d, load in old.items() if snapshot is None or d != str(snapshot)}
        tables[name] = Table(table.schema, kept | table.loads)
    version = Version(before.number + 1, tables, before.keys | (keys or {}), before.notes | (notes or {}))
    if max(numbers(spark, root), default=0) != before.number:
        raise VersionConflict(f"{root} has a version after {before.number}")
    _rename_new(spark, root, version)
    return version


def _rename_new(spark: SparkSession, root: str, version: Version) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    system, draft = file_system(spark, f"{root.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(version.text().encode()))
    stream.close()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(_manifest(root, version.number))
    context = hadoop.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, target, no_options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise VersionConflict(f"{root} has a version {version.number}") from error
        raise


def write_version(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], snapshot: Snapshot = None, balance: bool = False
) -> Version:
    """Write and publish several tables in one step."""
    before = find(spark, root)
    staged = {name: stage(spark, root, name, rows, balance) for name, rows in tables.items()}
    return publish(spark, root, before, staged, snapshot)


def load_relational(
    spark: SparkSession, datasets: dict[str, DataFrame], root: str, date: dt.date | str
) -> Version:
    """Stamp all datasets with their snapshot date and replace that snapshot of all of them at once."""
    stamp = F.lit(str(date)).cast("date")
    stamped = {name: df.withColumn("snapshot_date", stamp) for name, df in datasets.items()}
    return write_version(spark, root, stamped, str(date))


def expire(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all versions but the newest ``keep``, and the loads only they name; returns these folders.

    A load that no version names may still be under way: it goes only if an expired
    version names it. Manifests go first, so that no readable version lacks files.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    known = numbers(spark, root)
    old, kept = known[:-keep], known[-keep:]

    def folders(number: int) -> set[str]:
        tables = find(spark, root, number).tables.items()
        return {f"{n}/load_id={load}/snapshot_date={d}" for n, t in tables for d, load in t.loads.items()}

    gone = set().union(*map(folders, old)) - set().union(*map(folders, kept))
    for path in [_manifest(root, n) for n in old] + [f"{root.rstrip('/')}/{f}" for f in sorted(gone)]:
        system, target = file_system(spark, path)
        system.delete(target, True)
    return sorted(gone)
