"""Quality rules over the typed dirty feed and the clean history."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cleaning, stored, views
from checks.registry import add
from tramline import schemas
from tramline.functions.snapshots import ALL
from tramline.operators import quality
from tramline.sources import feed as feeds
from tramline.sources import listing, tables

NO_SAMPLE = "CAST(NULL AS STRING) AS sample"


def row(rule: str, dataset: str, field: str, count: str, origin: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{dataset}' AS dataset, '{field}' AS field, "
        f"CAST({count} AS BIGINT) AS violations, {NO_SAMPLE} FROM {origin}"
    )


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def nulls_sql(columns, prefix: str) -> str:
    return union(
        row("null_identifier", d, c, f"count(*) FILTER (WHERE {c} IS NULL)", f"{prefix}{d}")
        for d, cols in columns.items()
        for c in cols
    )


def surplus_sql(rule: str, keys, prefix: str, names=None) -> str:
    """Rows after the first of their key: all rows minus distinct keys."""
    return union(
        row(
            rule,
            d,
            (names or {}).get(d, ",".join(k)),
            f"count(*) - count(DISTINCT row({', '.join(k)}))",
            f"{prefix}{d}",
        )
        for d, k in keys.items()
    )


def gaps_sql(rule, child, cols, parent, prefix, null_keys=True, names=None) -> str:
    """Distinct unmatched keys; NULL never matches."""
    match = " AND ".join(f"p.{c} = c.{c}" for c in cols)
    text = " || '|' || ".join(f"CAST({c} AS STRING)" for c in cols)
    if len(cols) == 1:
        text = f"coalesce({text}, '')"
    keep = "" if null_keys else " AND " + " AND ".join(f"c.{c} IS NOT NULL" for c in cols)
    gaps = (
        f"SELECT DISTINCT {', '.join(cols)} FROM {prefix}{child} c WHERE NOT EXISTS "
        f"(SELECT 1 FROM {prefix}{parent} p WHERE {match}){keep}"
    )
    return (
        f"SELECT '{rule}' AS rule, '{child}' AS dataset, '{','.join(cols)}' AS field, "
        f"(SELECT count(*) FROM ({gaps})) AS violations, "
        f"(SELECT nullif(string_agg(k, ', ' ORDER BY k), '') FROM "
        f"(SELECT {text} AS k FROM ({gaps}) ORDER BY k LIMIT 5)) AS sample"
    )


def _typed(spark, sf):
    return views.typed_feed(spark, sf)


def _folder(spark, sf):
    return listing.latest_raw_snapshot(spark, stored.raw_root(spark, sf))[1]


# --- datasets -------------------------------------------------------------


def _some_empty(spark, sf):
    feed = _typed(spark, sf)
    feed["calendar_dates"] = feed["calendar_dates"].where("exception_type > 9")
    return feed


add(
    "v03_empty_datasets",
    lambda spark, sf: quality.empty_datasets(_some_empty(spark, sf)),
    union(
        row(
            "no_records",
            d,
            "*",
            "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
            f"t_{d}" + (" WHERE exception_type > 9" if d == "calendar_dates" else ""),
        )
        for d in schemas.DATASETS
    ),
)

# --- raw rules ------------------------------------------------------------

V4 = nulls_sql(schemas.RAW_IDENTIFIERS, "t_")
V5 = surplus_sql(
    "duplicate_row",
    {d: cleaning.fields(d) for d in schemas.DATASETS},
    "t_",
    {d: "*" for d in schemas.DATASETS},
)
REFERENCES = [
    gaps_sql("missing_reference", child, [key], parent, "t_")
    for child, key, parent in schemas.REFERENCES
]
OUTSIDE = "stop_lat < -90 OR stop_lat > 90 OR stop_lon < -180 OR stop_lon > 180"
V9 = union(
    row("coordinates", "stops", f, f"count(*) FILTER (WHERE {c})", "t_stops")
    for f, c in (
        ("stop_lat missing", "stop_lat IS NULL"),
        ("stop_lon missing", "stop_lon IS NULL"),
        ("out of range", OUTSIDE),
    )
)
add(
    "v04_null_identifiers",
    lambda spark, sf: quality.null_identifiers(_typed(spark, sf)),
    V4,
)
add("v05_duplicate_rows", lambda spark, sf: quality.duplicate_rows(_typed(spark, sf)), V5)
for number, (child, key, parent) in enumerate(schemas.REFERENCES):
    add(
        f"v{number + 6:02d}_{child}_{key}",
        lambda spark, sf, c=child, k=key: quality.broken_references(
            _typed(spark, sf)
        ).where((F.col("dataset") == c) & (F.col("field") == k)),
        REFERENCES[number],
    )
add(
    "v09_coordinates",
    lambda spark, sf: quality.bad_coordinates(_typed(spark, sf)["stops"]),
    V9,
)
add(
    "v16_raw_report",
    lambda spark, sf: quality.raw_report(_typed(spark, sf)),
    union([V4, V5, *REFERENCES, V9]),
)

# --- processed rules ------------------------------------------------------

PROCESSED = {f"u_{d}": cleaning.typed_sql(d) for d in schemas.DATASETS}


def _processed(spark, sf):
    """The processed snapshot as it lies in the lake."""
    _, folder = listing.latest_processed_snapshot(spark, stored.lake_root(spark, sf))
    return tables.read_processed(spark, folder)


V10 = nulls_sql(schemas.PROCESSED_IDENTIFIERS, "u_")
V11 = surplus_sql("duplicate_key", schemas.BUSINESS_KEYS, "u_")
V12 = [
    gaps_sql("missing_reference", child, [key], parent, "u_")
    for child, key, parent in schemas.REFERENCES
]
CONTRACT = union(
    f"SELECT 'required_column' AS rule, '{d}' AS dataset, '{c}' AS field, "
    f"CAST(0 AS BIGINT) AS violations, {NO_SAMPLE}"
    for d, columns in schemas.PROCESSED_REQUIRED.items()
    for c in columns
)
add(
    "v10_processed_nulls",
    lambda spark, sf: quality.null_identifiers(
        _processed(spark, sf), schemas.PROCESSED_IDENTIFIERS
    ),
    V10,
    **PROCESSED,
)
add(
    "v11_duplicate_keys",
    lambda spark, sf: quality.duplicate_keys(_processed(spark, sf)),
    V11,
    **PROCESSED,
)
add(
    "v12_processed_references",
    lambda spark, sf: quality.broken_references(_processed(spark, sf)),
    union(V12),
    **PROCESSED,
)
add(
    "v12_processed_report",
    lambda spark, sf: quality.processed_report(_processed(spark, sf)),
    union([CONTRACT, V10, V11, *V12]),
    **PROCESSED,
)

# --- warehouse audits -----------------------------------------------------

HISTORY_KEYS = {d: schemas.UNIQUE_KEYS[d] for d in schemas.DATASETS}


def column_sql(tables) -> str:
    return union(
        row("column", d, label, f"count(*) FILTER (WHERE {test})", origin)
        for d, origin in tables.items()
        for label, test in [
            (f"{c} is null", f"{c} IS NULL") for c in schemas.NOT_NULL.get(d, ())
        ]
        + [
            (f"{c} longer than {n}", f"length({c}) > {n}")
            for c, n in schemas.MAX_LENGTH.get(d, {}).items()
        ]
    )


def _history_with_arrivals(spark, sf):
    return views.history(spark, sf) | {
        "realtime_bus_arrivals": views.arrivals(spark, sf)
    }


add(
    "v13_unique_keys",
    lambda spark, sf: quality.key_audit(views.history(spark, sf)),
    surplus_sql("unique_key", HISTORY_KEYS, "g_"),
)
add(
    "v13_star_unique_keys",
    lambda spark, sf: quality.key_audit(stored.star(spark, sf)),
    union(
        row(
            "unique_key",
            d,
            ",".join(schemas.UNIQUE_KEYS[d]),
            f"count(*) - count(DISTINCT row({', '.join(schemas.UNIQUE_KEYS[d])}))",
            origin,
        )
        for d, origin in (
            ("dim_route", "g_routes"),
            ("dim_stop", "g_stops"),
            ("dim_service", "s_service"),
            ("fact_trip", "s_trip"),
        )
    ),
)
add(
    "v14_columns",
    lambda spark, sf: quality.column_audit(_history_with_arrivals(spark, sf)),
    column_sql(
        {d: f"g_{d}" for d in schemas.DATASETS} | {"realtime_bus_arrivals": "arrivals"}
    ),
)


def _moved_ids(spark, sf):
    """History in which every 50th trip and call points at an id out of range."""
    tables = views.history(spark, sf)
    tables["trips"] = tables["trips"].withColumn(
        "route_id",
        F.expr("CASE WHEN TRY_CAST(trip_id AS BIGINT) % 50 = 0 THEN concat('x', route_id) "
               "ELSE route_id END"),
    )
    tables["stop_times"] = tables["stop_times"].withColumn(
        "stop_id",
        F.expr("CASE WHEN TRY_CAST(trip_id AS BIGINT) % 50 = 1 THEN concat('x', stop_id) "
               "ELSE stop_id END"),
    )
    return tables


MOVED = {
    "m_trips": "SELECT * REPLACE (CASE WHEN TRY_CAST(trip_id AS BIGINT) % 50 = 0 "
    "THEN 'x' || route_id ELSE route_id END AS route_id) FROM g_trips",
    "m_stop_times": "SELECT * REPLACE (CASE WHEN TRY_CAST(trip_id AS BIGINT) % 50 = 1 "
    "THEN 'x' || stop_id ELSE stop_id END AS stop_id) FROM g_stop_times",
    "m_routes": "SELECT * FROM g_routes",
    "m_stops": "SELECT * FROM g_stops",
}
add(
    "v15_foreign_keys",
    lambda spark, sf: quality.foreign_key_audit(_moved_ids(spark, sf)),
    union(
        gaps_sql("foreign_key", child, cols, parent, "m_", null_keys=False)
        for child, cols, parent in schemas.FOREIGN_KEYS
    ),
    **MOVED,
)
add(
    "v15_star_foreign_keys",
    lambda spark, sf: quality.foreign_key_audit(
        stored.star(spark, sf), schemas.STAR_FOREIGN_KEYS
    ),
    union(
        f"SELECT 'foreign_key' AS rule, '{child}' AS dataset, '{','.join(cols)}' AS field, "
        f"CAST(0 AS BIGINT) AS violations, {NO_SAMPLE}"
        for child, cols, _ in schemas.STAR_FOREIGN_KEYS
    ),
)


def _gated(spark, sf):
    """The gate lets a clean snapshot pass and hands its report on.

    The routes that only added trips name are added to the routes.
    """
    tables = views.newest(spark, sf).all()
    added = tables["trips"].where("route_id LIKE 'gone %'").select("route_id").distinct()
    tables["routes"] = tables["routes"].unionByName(added, allowMissingColumns=True)
    return quality.gate(
        quality.union_all(
            [
                quality.null_identifiers(tables),
                quality.broken_references(tables),
                quality.bad_coordinates(tables["stops"]),
            ]
        )
    )


ZERO = "SELECT '{}' AS rule, '{}' AS dataset, '{}' AS field, CAST(0 AS BIGINT) AS violations, "
add(
    "v16_gate",
    _gated,
    union(
        ZERO.format(*labels) + NO_SAMPLE
        for labels in (
            [("null_identifier", d, c) for d, cs in schemas.RAW_IDENTIFIERS.items() for c in cs]
            + [("missing_reference", child, key) for child, key, _ in schemas.REFERENCES]
            + [
                ("coordinates", "stops", f)
                for f in ("stop_lat missing", "stop_lon missing", "out of range")
            ]
        )
    ),
)
add(
    "v17_snapshot_counts",
    lambda spark, sf: quality.snapshot_counts(views.newest(spark, sf).all(), ALL),
    union(
        f"SELECT '{d}' AS dataset, count(*) AS rows FROM g_{d} "
        "WHERE snapshot_date = (SELECT d FROM newest)"
        for d in schemas.DATASETS
    ),
)
add(
    "v18_history",
    lambda spark, sf: quality.history(views.history(spark, sf)["trips"]),
    "SELECT snapshot_date, count(*) AS total_registros FROM g_trips GROUP BY 1",
)
add(
    "v19_final_report",
    lambda spark, sf: quality.final_report(_typed(spark, sf)),
    union(
        f"SELECT '{d}' AS dataset, count(*) AS rows, "
        "CAST(coalesce(sum("
        + " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in cleaning.fields(d))
        + "), 0) AS BIGINT) AS nulls, "
        f"count(*) - count(DISTINCT row({', '.join(cleaning.fields(d))})) AS duplicates, "
        + (
            "count(*) - count(DISTINCT row(stop_id))"
            if d == "stops"
            else "CAST(NULL AS BIGINT)"
        )
        + f" AS duplicate_stop_ids FROM t_{d}"
        for d in schemas.DATASETS
    ),
)
