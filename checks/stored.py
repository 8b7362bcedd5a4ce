"""Tables the queries read that have to be written first.

Each is built once per application and input, in the shared scratch folder, and
only by the queries that need it. A change of the input files gives a new build.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from tramline import schemas
from tramline.functions.snapshots import ALL, Tables, many_snapshots
from tramline.operators import clean
from tramline.plans.warehouse import STAR, load_star, newest_dates, open_star, open_tables
from tramline.session import scratch_dir
from tramline.sources import listing, tables
from tramline.streaming import jobs

_built: dict[tuple, str] = {}
_lock = threading.RLock()

NEWEST_RAW = "2026-01-05"


def _version(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the input's file list: names, sizes and times, combined in Spark."""
    files = listing.list_files(spark, sf_dir, "*.parquet")
    row = files.agg(
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.count(F.lit(1))
    ).first()
    return f"{row[0]}-{row[1]}"


def _once(
    spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]
) -> str:
    with _lock:
        app = spark.sparkContext.applicationId
        key = (app, sf_dir, _version(spark, sf_dir), label)
        if key not in _built:
            path = scratch_dir(spark, label)
            build(path)
            _built[key] = path
        return _built[key]


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema over the whole history, loaded by the library's own load."""
    return open_star(spark, star_root(spark, sf_dir))


def lazy_star(spark: SparkSession, sf_dir: str) -> views.Lazy:
    root = star_root(spark, sf_dir)
    lazy = views.Lazy(STAR, lambda name: tables.read_table(spark, f"{root}/{name}"))
    lazy.newest = newest_dates(spark, root)
    return lazy


def build_star(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    return load_star(spark, views.history(spark, sf_dir), path, ALL)


def star_root(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "star", lambda path: build_star(spark, sf_dir, path))


def write_feed(feed: dict[str, DataFrame], folder: str) -> None:
    for name, df in feed.items():
        (
            df.write.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/{name}.txt")
        )


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """Raw snapshots: the dirty feed, an older one, and a newer one not extracted."""

    def build(path: str) -> None:
        write_feed(
            views.dirty_feed(spark, sf_dir), f"{path}/{NEWEST_RAW}/extracted"
        )
        agency = views.dirty(spark, sf_dir, "agency")
        write_feed({"agency": agency}, f"{path}/2025-12-29/extracted")
        write_feed({"agency": agency}, f"{path}/2026-02-01/download")

    return _once(spark, sf_dir, "raw", build)


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """Processed snapshots: the cleaned feed and an older day."""

    def build(path: str) -> None:
        feed = clean.clean_feed(views.typed_feed(spark, sf_dir))
        tables.write_processed(feed, path, NEWEST_RAW)
        tables.write_processed({"agency": feed["agency"]}, path, "2025-12-29")

    return _once(spark, sf_dir, "lake", build)


def relational_root(spark: SparkSession, sf_dir: str) -> str:
    """Relational tables: the cleaned feed loaded as two snapshots, one of them twice."""

    def build(path: str) -> None:
        _, folder = listing.latest_processed_snapshot(spark, lake_root(spark, sf_dir))
        processed = tables.read_processed(spark, folder)
        agency = {"agency": processed["agency"], "trips": processed["trips"]}
        tables.load_relational(agency, path, "2025-12-29")
        for _ in range(2):
            tables.load_relational(processed, path, NEWEST_RAW)

    return _once(spark, sf_dir, "relational", build)


def stream_root(spark: SparkSession, sf_dir: str) -> str:
    """Outputs of the streaming query over all messages, read as text files."""

    def build(path: str) -> None:
        views.messages(spark, sf_dir).select("value").write.text(f"{path}/in")
        query = jobs.start(
            jobs.text_source(spark, f"{path}/in"),
            jobs.fan_out(jobs.table_writers(f"{path}/out")),
            f"{path}/checkpoint",
            once=True,
        )
        query.awaitTermination()

    return _once(spark, sf_dir, "stream", build) + "/out"


def relational_history(spark: SparkSession, sf_dir: str) -> Tables:
    """The relational tables with every yearly snapshot, as the loads leave them."""

    def build(path: str) -> None:
        data = views.history(spark, sf_dir)
        balance = many_snapshots(data["trips"])
        for name, df in data.items():
            tables.replace_snapshots(df, f"{path}/{name}", balance=balance)

    root = _once(spark, sf_dir, "history", build)
    return open_tables(spark, root, schemas.DATASETS)


def datasets(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: tables.read_table(spark, f"{root}/{name}") for name in schemas.DATASETS}
