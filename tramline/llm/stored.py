"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tramline.session import scratch_dir


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table of its own: a lost executor costs no earlier stage."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs within the block hands rows to Python in batches of about ``size`` bytes, one row at least.

    A batch exists in the JVM, on its way and in Python, for each column of each
    task; rows of long texts would make it many times larger than what is worked on.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parts_of(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
