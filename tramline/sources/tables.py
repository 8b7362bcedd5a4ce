"""Parquet history tables, the lake layout, CSV exports and JDBC tables."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.snapshots import ALL, Snapshot
from tramline.sources.listing import EMPTY_MARK, file_system, is_missing, subfolders


def day_path(root: str, date: dt.date | str) -> str:
    """``<root>/year=YYYY/month=MM/day=DD`` for an ISO date."""
    iso = date.isoformat() if isinstance(date, dt.date) else date
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", iso):
        raise ValueError(f"not an ISO date: {iso!r}")
    year, month, day = iso.split("-")
    return f"{root.rstrip('/')}/year={year}/month={month}/day={day}"


def lake_path(lake: str, zone: str, feed: str, date: dt.date | str, relative: str) -> str:
    """Object path of one file of a snapshot: ``<lake>/<zone>/<feed>/year=…/<relative>``."""
    return f"{day_path(f'{lake.rstrip('/')}/{zone}/{feed}', date)}/{relative.lstrip('/')}"


def write_processed(
    datasets: dict[str, DataFrame], root: str, date: dt.date | str
) -> dict[str, str]:
    """Overwrite each dataset as Parquet below the day folder; returns the paths."""
    paths = {name: f"{day_path(root, date)}/{name}" for name in datasets}
    for name, df in datasets.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def read_processed(
    spark: SparkSession, folder: str, datasets: tuple[str, ...] = schemas.DATASETS
) -> dict[str, DataFrame]:
    """All Parquet parts of each processed dataset; missing or empty ones are errors.

    Only an optional dataset may have no rows.
    """
    out = {}
    for name in datasets:
        path = f"{folder.rstrip('/')}/{name}"
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            raise FileNotFoundError(f"no Parquet files for {name}: {path}") from error
        if name not in schemas.OPTIONAL_DATASETS and df.isEmpty():
            raise ValueError(f"the processed dataset {name} has no rows")
        out[name] = df
    return out


def write_csv(datasets: dict[str, DataFrame], root: str, date: dt.date | str) -> None:
    """Overwrite one CSV folder with header per dataset below ``<root>/<date>``."""
    iso = date.isoformat() if isinstance(date, dt.date) else date
    for name, df in datasets.items():
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .csv(f"{root.rstrip('/')}/{iso}/{name}.csv")
        )


def stage_snapshots(
    df: DataFrame, staged: str, snapshot: Snapshot = None, balance: bool = False
) -> None:
    """Write ``df`` by snapshot to a new folder, for ``swap_snapshots``.

    A date given as ``snapshot`` is written even if no row of it is left: as an
    empty file that keeps the schema, and a mark. ``balance`` spreads a frame of
    many snapshots so that each file belongs to one; oversized snapshots are
    split over several tasks.
    """
    spark = df.sparkSession
    rows = df.hint("rebalance", "snapshot_date") if balance else df
    rows.write.partitionBy("snapshot_date").parquet(staged)
    folder = f"snapshot_date={snapshot}"
    if named(snapshot) and folder not in subfolders(spark, staged):
        types = df.drop("snapshot_date").schema
        spark.createDataFrame([], types).write.parquet(f"{staged}/{folder}")
        system, mark = file_system(spark, f"{staged}/{folder}/{EMPTY_MARK}")
        system.create(mark).close()


def named(snapshot: Snapshot) -> bool:
    """Whether the snapshot is a date, not all of them or one to be looked up."""
    return isinstance(snapshot, dt.date) or isinstance(snapshot, str) and snapshot != ALL


def swap_snapshots(
    spark: SparkSession, staged: str, path: str, snapshot: Snapshot = None
) -> None:
    """Put staged snapshots in the place of stored ones, by renaming folders.

    Nothing is computed here. ``ALL`` also drops stored snapshots that were not
    staged; otherwise they stay as they are.
    """
    system, root = file_system(spark, path)
    system.mkdirs(root)
    new = {n for n in subfolders(spark, staged) if n.startswith("snapshot_date=")}
    old = {n for n in subfolders(spark, path) if n.startswith("snapshot_date=")}
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    everything = isinstance(snapshot, str) and snapshot == ALL
    for name in sorted(old if everything else old & new):
        system.delete(path_of(f"{path}/{name}"), True)
    for name in sorted(new):
        if not system.rename(path_of(f"{staged}/{name}"), path_of(f"{path}/{name}")):
            raise OSError(f"cannot move {staged}/{name} to {path}")
    system.delete(path_of(staged), True)


def replace_snapshots(
    df: DataFrame, path: str, balance: bool = False, snapshot: Snapshot = None
) -> None:
    """Replace the snapshots present in ``df``, and the one named, even by nothing.

    ``ALL`` replaces every stored snapshot. The new rows are written next to the
    table and swapped in when they are complete.
    """
    path = path.rstrip("/")
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    stage_snapshots(df, staged, snapshot, balance)
    swap_snapshots(df.sparkSession, staged, path, snapshot)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while it has never been written."""
    system, target = file_system(spark, path)
    return spark.read.parquet(path) if system.exists(target) else None


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table; pass partitionColumn/lowerBound/upperBound/numPartitions
    to read it in parallel."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .options(**options)
        .load()
    )


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .options(**options)
        .mode("append")
        .save()
    )


def load_relational(
    datasets: dict[str, DataFrame], root: str, date: dt.date | str
) -> None:
    """Stamp every dataset with its snapshot date and replace that snapshot, even by nothing."""
    for name, df in datasets.items():
        stamped = df.withColumn("snapshot_date", F.lit(str(date)).cast("date"))
        replace_snapshots(stamped, f"{root.rstrip('/')}/{name}", snapshot=str(date))
