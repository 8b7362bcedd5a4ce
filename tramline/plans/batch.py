"""The batch path: feed folder to checked star schema."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from tramline import schemas
from tramline.operators import clean, quality
from tramline.plans.warehouse import load_star
from tramline.session import scratch_dir
from tramline.sources import feed, listing, tables

logger = logging.getLogger(__name__)


def stage_feed(
    spark: SparkSession, folder: str, root: str | None = None
) -> dict[str, DataFrame]:
    """Check files, columns and records of a raw folder; the typed feed as Parquet.

    The text files are parsed once, below ``root`` (default: a new folder in the
    shared scratch folder). All later rules and the cleaning read columns from there.
    """
    root = root or scratch_dir(spark, "feed")
    quality.gate(quality.missing_files(spark, feed.discovered_files(spark, folder)))
    headers = {
        name: feed.read_text(spark, folder, name).columns for name in schemas.TEXT_DATASETS
    }
    quality.gate(quality.missing_columns(spark, headers))
    staged = {}
    for name, df in feed.read_feed(spark, folder).items():
        df.write.parquet(f"{root}/{name}")
        staged[name] = tables.read_table(spark, f"{root}/{name}")
    quality.gate(
        quality.empty_datasets({name: staged[name] for name in schemas.TEXT_DATASETS})
    )
    return staged


def _drop(spark: SparkSession, folder: str) -> None:
    system, target = listing.file_system(spark, folder)
    system.delete(target, True)


def run_batch(spark: SparkSession, raw_root: str, lake_root: str, warehouse: str) -> DataFrame:
    """Newest raw snapshot through cleaning, gates, lake, tables and star.

    The same chooser yields the date and the folder. Any violated rule raises
    before the next stage writes. Returns the load report.
    """
    date, folder = listing.latest_raw_snapshot(spark, raw_root)
    logger.info("raw snapshot %s from %s", date, folder)
    scratch = scratch_dir(spark, "feed")
    try:
        typed = stage_feed(spark, folder, scratch)
        quality.gate(quality.raw_report(typed))
        tables.write_processed(clean.clean_feed(typed), lake_root, date)
    finally:
        _drop(spark, scratch)
    date, folder = listing.latest_processed_snapshot(spark, lake_root)
    processed = tables.read_processed(spark, folder)
    quality.gate(quality.processed_report(processed))

    relational = f"{warehouse.rstrip('/')}/relational"
    tables.load_relational(processed, relational, date)
    stored = {
        name: tables.read_table(spark, f"{relational}/{name}") for name in processed
    }
    return load_star(spark, stored, f"{warehouse.rstrip('/')}/star", date)


def run_text_batch(spark: SparkSession, raw_root: str, csv_root: str) -> DataFrame:
    """Newest raw snapshot through the text rules to one CSV folder per dataset.

    Every column stays text but coordinates and sequence numbers. Returns the
    final report, on the written files: rows, NULL cells, copies, repeated stops.
    """
    date, folder = listing.latest_raw_snapshot(spark, raw_root)
    logger.info("raw snapshot %s from %s", date, folder)
    cleaned = clean.clean_text_feed(feed.read_text_feed(spark, folder))
    tables.write_csv(cleaned, csv_root, date)
    written = {
        name: spark.read.option("header", True)
        .option("escape", '"')
        .schema(df.schema)
        .csv(f"{csv_root.rstrip('/')}/{date}/{name}.csv")
        for name, df in cleaned.items()
    }
    return quality.final_report(written)
