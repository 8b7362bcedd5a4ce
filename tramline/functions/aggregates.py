"""Aggregate building blocks that stay balanced under skewed keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_true(condition: Column) -> Column:
    """Rows where the condition holds; 0 (not NULL) on an empty input."""
    return F.count(F.when(condition, 1))


def count_null(name: str) -> Column:
    return count_true(F.col(name).isNull())


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows come after the first of their key (NULL keys equal).

    Partial aggregation collapses a hot key before the shuffle, and the second
    step only adds up one number per task.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n"))
    )


def missing_keys(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct child keys without a parent; a NULL key never has one.

    Both sides shrink to distinct keys before the join, so a key that fills a
    third of the child costs one row. They meet where that left them, by merging:
    as a broadcast the parent's keys would pass through the driver whenever their
    size is underestimated.
    """
    parents = parent.select(*keys).distinct().hint("merge")
    return child.select(*keys).distinct().join(parents, list(keys), "left_anti")


def orphan_rows(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Distinct child keys without a parent and their row counts, NULL matching NULL."""
    parents = parent.select(F.col(parent_key or key).alias("_parent")).distinct()
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(
        parents, counts[key].eqNullSafe(parents["_parent"]), "left_anti"
    )
