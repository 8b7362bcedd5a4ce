"""Reading the text files of one feed snapshot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.sources.listing import entries

SOURCE_ROW = "_source_row"
ORDERED = ("stops",)  # datasets with a "first row wins" rule


class FeedError(ValueError):
    """The feed folder does not meet its contract."""


def file_path(folder: str, dataset: str) -> str:
    return f"{folder.rstrip('/')}/{dataset}.txt"


def read_text(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """One file with every column as text; only the header line is looked at.

    A doubled quote inside a quoted field is one quote. Feed files may not hold
    line breaks in fields, so files stay splittable.
    """
    return (
        spark.read.option("header", True).option("escape", '"').csv(file_path(folder, dataset))
    )


def read_text_feed(
    spark: SparkSession,
    folder: str,
    datasets: Iterable[str] = schemas.TEXT_DATASETS,
    ordered: Iterable[str] = ORDERED,
) -> dict[str, DataFrame]:
    """The mandatory files as text columns.

    An empty field is NULL; tokens such as ``NA`` stay text, they can be names.
    Datasets in ``ordered`` get the position of each row in the feed, which
    "first row wins" rules need. It is fixed by file, split and row, so a
    repeated task yields the same value.
    """
    out = {}
    for name in datasets:
        df = read_text(spark, folder, name)
        if name in ordered:
            df = df.withColumn(
                SOURCE_ROW,
                F.struct(
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ),
            )
        out[name] = df
    return out


def read_feed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven datasets with declared types.

    Columns are picked by header name, so their order in the file and extra
    columns do not matter. Ids keep leading zeros and clock times stay text
    because nothing is inferred. A missing optional file gives an empty frame.
    """
    present = discovered_files(spark, folder)
    out = {}
    for name in schemas.DATASETS:
        schema = schemas.feed_schema(name)
        if name in schemas.OPTIONAL_DATASETS and f"{name}.txt" not in present:
            out[name] = spark.createDataFrame([], schema)
            continue
        raw = read_text(spark, folder, name)
        missing = sorted(set(schema.fieldNames()) - set(raw.columns))
        if missing:
            raise FeedError(f"{name}.txt lacks the columns {missing}")
        out[name] = raw.select(
            *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema)
        )
    return out


def discovered_files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the feed files in the folder; each may also be a folder of parts."""
    return {
        name
        for name, is_folder, size in entries(spark, folder)
        if name.endswith(".txt") and (is_folder or size)
    }
