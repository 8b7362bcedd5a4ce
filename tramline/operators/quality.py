"""Data-quality rules.

Every rule returns rows ``(rule, dataset, field, violations, sample)``; zero
violations means it holds. ``gate`` turns a report into an error. Each table is
read by one aggregate per kind of rule, not by one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.aggregates import (
    count_null,
    count_true,
    missing_keys,
    surplus_rows,
    union_all,
)
from tramline.functions.snapshots import at_snapshot

Datasets = Mapping[str, DataFrame]
REPORT = "rule STRING, dataset STRING, field STRING, violations BIGINT, sample STRING"
SAMPLE_SIZE = 5


class QualityError(ValueError):
    """At least one rule of a report is violated."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__(
            "; ".join(
                f"{r['rule']}: {r['dataset']}.{r['field']} has {r['violations']} violations"
                + (f" ({r['sample']})" if r["sample"] else "")
                for r in failures
            )
        )


Rule = tuple[str, str]  # rule name, field


def _rows(df: DataFrame, dataset: str, counts: Mapping[Rule, Column]) -> DataFrame:
    """One aggregate pass over ``df``, one report row per count."""
    totals = df.agg(
        *(
            F.coalesce(c, F.lit(0)).cast("bigint").alias(f"c{i}")
            for i, c in enumerate(counts.values())
        )
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"), F.lit(field).alias("field"), F.col(f"c{i}").alias("n")
            )
            for i, (rule, field) in enumerate(counts)
        )
    )
    return totals.select(F.explode(entries).alias("e")).select(
        F.col("e.rule").alias("rule"),
        F.lit(dataset).alias("dataset"),
        F.col("e.field").alias("field"),
        F.col("e.n").alias("violations"),
        F.lit(None).cast("string").alias("sample"),
    )


def _key_rows(
    df: DataFrame,
    dataset: str,
    keys: Sequence[str],
    surplus: Rule,
    others: Mapping[Rule, Column] | None = None,
) -> DataFrame:
    """Rows after the first of their key, and other counts, in one pass.

    Rows of one key are folded into one before and after the only shuffle; the
    other counts are folded along with them and added up at the end.
    """
    others = others or {}
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *(c.alias(f"_o{i}") for i, c in enumerate(others.values())),
    )
    counts = {surplus: F.sum(F.col("_n") - 1)} | {
        rule: F.sum(f"_o{i}") for i, rule in enumerate(others)
    }
    return _rows(folded, dataset, counts)


def _fixed(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT)


# --- the files themselves -------------------------------------------------


def missing_files(spark: SparkSession, found: set[str]) -> DataFrame:
    """One row per mandatory file, violated when it is absent or has no bytes.

    Extra files are fine.
    """
    return _fixed(
        spark,
        [
            ("required_file", name, f"{name}.txt", int(f"{name}.txt" not in found), None)
            for name in schemas.TEXT_DATASETS
        ],
    )


def missing_columns(
    spark: SparkSession,
    columns: Mapping[str, Sequence[str]],
    contract: Mapping[str, Sequence[str]] = schemas.RAW_REQUIRED,
) -> DataFrame:
    """One row per contracted column, violated when the header lacks it."""
    return _fixed(
        spark,
        [
            ("required_column", name, c, int(c not in set(columns.get(name, ()))), None)
            for name, required in contract.items()
            for c in required
        ],
    )


def empty_datasets(datasets: Datasets) -> DataFrame:
    """Violated (1) for every dataset without a row."""
    empty = F.when(F.count(F.lit(1)) == 0, 1)
    return union_all(
        [_rows(df, name, {("no_records", "*"): empty}) for name, df in datasets.items()]
    )


# --- rules on rows --------------------------------------------------------


def _nulls(columns: Sequence[str]) -> dict[Rule, Column]:
    return {("null_identifier", c): count_null(c) for c in columns}


def null_identifiers(
    datasets: Datasets, columns: Mapping[str, Sequence[str]] = schemas.RAW_IDENTIFIERS
) -> DataFrame:
    return union_all(
        [
            _rows(datasets[name], name, _nulls(cols))
            for name, cols in columns.items()
            if name in datasets
        ]
    )


def duplicate_rows(datasets: Datasets) -> DataFrame:
    return union_all(
        [
            _key_rows(df, name, df.columns, ("duplicate_row", "*"))
            for name, df in datasets.items()
        ]
    )


def duplicate_keys(
    datasets: Datasets,
    keys: Mapping[str, Sequence[str]] = schemas.BUSINESS_KEYS,
    rule: str = "duplicate_key",
) -> DataFrame:
    """Rows after the first of their business key; NULL parts compare equal."""
    return union_all(
        [
            _key_rows(datasets[name], name, cols, (rule, ",".join(cols)))
            for name, cols in keys.items()
            if name in datasets
        ]
    )


def _unmatched(
    rule: str, child: str, keys: Sequence[str], gaps: DataFrame, null_keys: bool = True
) -> DataFrame:
    """Count of distinct unmatched keys and the first few of them.

    The sample is a bounded top-k, so it never gathers the key set in one place.
    """
    if not null_keys:
        gaps = gaps.dropna(subset=list(keys))
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    label = (F.lit(rule), F.lit(child), F.lit(",".join(keys)))
    names = ("rule", "dataset", "field")
    count = gaps.agg(F.count(F.lit(1)).alias("violations"))
    first = (
        gaps.select(text.alias("k"))
        .orderBy("k")
        .limit(SAMPLE_SIZE)
        .agg(F.array_join(F.sort_array(F.collect_list("k")), ", ").alias("s"))
    )
    return count.select(
        *(c.alias(n) for c, n in zip(label, names)),
        "violations",
        F.nullif(first.scalar(), F.lit("")).alias("sample"),
    )


def broken_references(datasets: Datasets) -> DataFrame:
    """Distinct child ids without a parent row. A NULL id counts as one such id."""
    return union_all(
        [
            _unmatched(
                "missing_reference",
                child,
                [key],
                missing_keys(datasets[child], datasets[parent], [key]),
            )
            for child, key, parent in schemas.REFERENCES
            if child in datasets and parent in datasets
        ]
    )


def _coordinates() -> dict[Rule, Column]:
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    outside = ~lat.between(-90.0, 90.0) | ~lon.between(-180.0, 180.0)
    return {
        ("coordinates", "stop_lat missing"): count_null("stop_lat"),
        ("coordinates", "stop_lon missing"): count_null("stop_lon"),
        ("coordinates", "out of range"): count_true(outside),
    }


def bad_coordinates(stops: DataFrame) -> DataFrame:
    return _rows(stops, "stops", _coordinates())


def raw_report(datasets: Datasets) -> DataFrame:
    """Identifier, duplicate, reference and coordinate rules of a typed snapshot.

    The rules on single tables share one scan and one shuffle per table.
    """
    tables = [
        _key_rows(
            df,
            name,
            df.columns,
            ("duplicate_row", "*"),
            _nulls(schemas.RAW_IDENTIFIERS.get(name, ()))
            | (_coordinates() if name == "stops" else {}),
        )
        for name, df in datasets.items()
    ]
    return union_all([*tables, broken_references(datasets)])


# --- processed snapshots --------------------------------------------------


def processed_report(datasets: Datasets) -> DataFrame:
    """All rules a processed snapshot must meet before it is loaded."""
    names = {name: df.columns for name, df in datasets.items()}
    columns = missing_columns(
        next(iter(datasets.values())).sparkSession, names, schemas.PROCESSED_REQUIRED
    )
    if any(
        set(required) - set(names.get(name, ()))
        for name, required in schemas.PROCESSED_REQUIRED.items()
    ):
        return columns  # the row rules need these columns
    return union_all(
        [
            columns,
            *(
                _key_rows(
                    datasets[name],
                    name,
                    keys,
                    ("duplicate_key", ",".join(keys)),
                    _nulls(schemas.PROCESSED_IDENTIFIERS[name]),
                )
                for name, keys in schemas.BUSINESS_KEYS.items()
            ),
            broken_references(datasets),
        ]
    )


# --- warehouse audits -----------------------------------------------------


def key_audit(tables: Datasets) -> DataFrame:
    """Primary and unique keys of the stored tables."""
    return duplicate_keys(tables, schemas.UNIQUE_KEYS, "unique_key")


def column_audit(tables: Datasets) -> DataFrame:
    """NOT NULL columns and text lengths, one pass per table."""
    reports = []
    for name, df in tables.items():
        rules = {
            ("column", f"{c} is null"): count_null(c)
            for c in schemas.NOT_NULL.get(name, ())
            if c in df.columns
        } | {
            ("column", f"{c} longer than {n}"): count_true(F.length(c) > n)
            for c, n in schemas.MAX_LENGTH.get(name, {}).items()
            if c in df.columns
        }
        if rules:
            reports.append(_rows(df, name, rules))
    return union_all(reports)


def foreign_key_audit(
    tables: Datasets, keys: Sequence[tuple] = schemas.FOREIGN_KEYS
) -> DataFrame:
    """Distinct composite child keys without a parent; NULL keys are not checked."""
    return union_all(
        [
            _unmatched(
                "foreign_key",
                child,
                cols,
                missing_keys(tables[child], tables[parent], cols),
                null_keys=False,
            )
            for child, cols, parent in keys
            if child in tables and parent in tables
        ]
    )


def gate(report: DataFrame) -> DataFrame:
    """Raise on any violation, else hand the report on. Reports have a fixed, small size."""
    rows = report.collect()
    failures = [r for r in rows if r["violations"]]
    if failures:
        raise QualityError(failures)
    return report.sparkSession.createDataFrame(rows, REPORT)


# --- counts ---------------------------------------------------------------


def row_counts(datasets: Datasets) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("dataset"), "rows"
            )
            for name, df in datasets.items()
        ]
    )


def snapshot_counts(tables: Datasets, snapshot) -> DataFrame:
    """Rows per table of one stored snapshot."""
    return row_counts({n: at_snapshot(df, snapshot) for n, df in tables.items()})


def history(trips: DataFrame) -> DataFrame:
    """Trips per stored snapshot, oldest first."""
    return (
        trips.groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("total_registros"))
        .orderBy("snapshot_date")
    )


def final_report(datasets: Datasets) -> DataFrame:
    """Rows, NULL cells, duplicate rows per dataset, and repeated stop ids."""
    parts = []
    for name, df in datasets.items():
        nulls = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0))
        # Copies are folded first: one scan and one shuffle give all three numbers.
        folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            folded.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
                F.coalesce(F.sum(nulls * F.col("_n")), F.lit(0))
                .cast("bigint")
                .alias("nulls"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
                .cast("bigint")
                .alias("duplicates"),
            ).select(F.lit(name).alias("dataset"), "rows", "nulls", "duplicates")
        )
    report = union_all(parts)
    repeated = surplus_rows(datasets["stops"], ["stop_id"])
    return report.withColumn(
        "duplicate_stop_ids",
        F.when(F.col("dataset") == "stops", repeated.scalar()),
    )
