"""Sources, sinks and the star load."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cleaning, profiling, stored, views
from checks.registry import add
from tramline import schemas
from tramline.functions.aggregates import count_null, union_all
from tramline.functions.snapshots import ALL, at_snapshot
from tramline.operators import clean, dimensional, quality
from tramline.plans import warehouse
from tramline.session import scratch_dir
from tramline.sources import feed as feeds
from tramline.sources import listing, tables, versions

union = profiling.union
NEWEST_RAW = f"DATE '{stored.NEWEST_RAW}'"


def _raw_folder(spark, sf):
    return listing.latest_raw_snapshot(spark, stored.raw_root(spark, sf))[1]


# --- sources --------------------------------------------------------------

for name in ("stops", "stop_times", "calendar"):
    add(
        f"s01_read_feed_{name}",
        lambda spark, sf, n=name: feeds.read_feed(spark, _raw_folder(spark, sf))[n],
        f"SELECT * FROM t_{name}",
    )
for name in ("routes", "trips"):
    add(
        f"s02_read_text_{name}",
        lambda spark, sf, n=name: feeds.read_text_feed(spark, _raw_folder(spark, sf), [n])[n],
        f"SELECT * FROM d_{name}",
    )


def _first_read_stops(spark, sf):
    """First row per stop id by feed position: read, stripped, reduced."""
    feed = feeds.read_text_feed(spark, _raw_folder(spark, sf), ["routes", "stops"])
    return clean.clean_text_feed(feed)["stops"]


add(
    "s02_read_and_clean_stops",
    _first_read_stops,
    cleaning.text_rules_sql("stops"),
)


def _latest_raw(spark, sf):
    date, folder = listing.latest_raw_snapshot(spark, stored.raw_root(spark, sf))
    rows = feeds.read_text(spark, folder, "trips").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(date).alias("snapshot_date"), "rows")


add(
    "s03_latest_raw_snapshot",
    _latest_raw,
    f"SELECT {NEWEST_RAW} AS snapshot_date, count(*) AS rows FROM d_trips",
)


def _latest_processed(spark, sf):
    date, folder = listing.latest_processed_snapshot(spark, stored.lake_root(spark, sf))
    rows = tables.read_table(spark, f"{folder}/trips").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(date).alias("snapshot_date"), "rows")


add(
    "s04_latest_processed_snapshot",
    _latest_processed,
    f"SELECT {NEWEST_RAW} AS snapshot_date, count(*) AS rows "
    f"FROM ({cleaning.typed_sql('trips')})",
)


def _processed(spark, sf):
    _, folder = listing.latest_processed_snapshot(spark, stored.lake_root(spark, sf))
    return tables.read_processed(spark, folder)


PROCESSED_COUNTS = cleaning._counts({d: cleaning.typed_sql(d) for d in schemas.DATASETS})
add(
    "s05_read_processed",
    lambda spark, sf: cleaning.content(_processed(spark, sf)),
    cleaning.content_sql({d: cleaning.typed_sql(d) for d in schemas.DATASETS}),
)
add(
    "s07_read_table",
    lambda spark, sf: tables.read_table(spark, f"{stored.star_root(spark, sf)}/dim_route").drop(
        "route_key"
    ),
    "SELECT * FROM g_routes",
)

# --- sinks ----------------------------------------------------------------

add(
    "k01_write_processed",
    lambda spark, sf: _processed(spark, sf)["calendar_dates"].unionByName(
        _processed(spark, sf)["calendar"]
        .select("service_id", F.col("start_date").alias("date"))
        .withColumn("exception_type", F.lit(None).cast("int"))
    ),
    f"SELECT * FROM ({cleaning.typed_sql('calendar_dates')}) UNION ALL "
    f"SELECT service_id, start_date, CAST(NULL AS INT) FROM ({cleaning.typed_sql('calendar')})",
)
add(
    "k01_processed_stop_times",
    lambda spark, sf: _processed(spark, sf)["stop_times"],
    cleaning.typed_sql("stop_times"),
)


def _csv_round_trip(spark, sf):
    path = scratch_dir(spark, "csv")
    routes = clean.clean_text_feed({"routes": views.dirty(spark, sf, "routes")})
    for _ in range(2):  # the second run overwrites the first
        tables.write_csv(routes, path, stored.NEWEST_RAW)
    return spark.read.option("header", True).csv(f"{path}/{stored.NEWEST_RAW}/routes.csv")


add("k02_write_csv", _csv_round_trip, cleaning.text_rules_sql("routes"))


def _replace_one(spark, sf):
    """History of trips after its newest snapshot was replaced by part of itself."""
    path = scratch_dir(spark, "replace")
    tables.replace_snapshots(views.history(spark, sf)["trips"], path, balance=True)
    part = views.newest(spark, sf)["trips"].where("direction_id = 1")
    for _ in range(2):
        tables.replace_snapshots(part, path)
    return tables.read_table(spark, path)


add(
    "k03_replace_snapshot",
    _replace_one,
    "SELECT * FROM g_trips WHERE direction_id = 1 OR snapshot_date <> (SELECT d FROM newest)",
)


def _replace_with_nothing(spark, sf):
    """History of trips after its newest snapshot was reloaded without rows."""
    path = scratch_dir(spark, "replace")
    trips = views.history(spark, sf)["trips"]
    tables.replace_snapshots(trips, path, balance=True)
    date = warehouse.newest(trips)
    tables.replace_snapshots(trips.limit(0), path, snapshot=date)
    return tables.read_table(spark, path)


add(
    "k03_replace_with_empty",
    _replace_with_nothing,
    "SELECT * FROM g_trips WHERE snapshot_date <> (SELECT d FROM newest)",
)


def _lake_layout(spark, sf):
    """Files of the lake folded to day folder and dataset, with their row counts.

    The datasets differ in columns, so one column stands in for all; only file
    names are used.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .schema("service_id STRING")
        .parquet(stored.lake_root(spark, sf))
        .select(
            F.regexp_extract(
                F.col("_metadata.file_path"),
                r"(year=\d+/month=\d+/day=\d+/[a-z_]+)/[^/]*\.parquet$",
                1,
            ).alias("folder")
        )
    )
    return rows.groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))


add(
    "k06_lake_layout",
    _lake_layout,
    "SELECT 'year=2026/month=01/day=05/' || dataset AS folder, rows "
    f"FROM ({PROCESSED_COUNTS}) UNION ALL SELECT 'year=2025/month=12/day=29/agency', "
    f"(SELECT count(*) FROM ({cleaning.typed_sql('agency')}))",
)

# --- relational load ------------------------------------------------------


def _relational(spark, sf):
    root = stored.relational_root(spark, sf)
    return stored.datasets(spark, root)


def _snapshots_sql(dataset: str) -> str:
    """A processed dataset as loaded: the newest snapshot, some also an older one."""
    sql = f"SELECT *, {NEWEST_RAW} AS snapshot_date FROM ({cleaning.typed_sql(dataset)})"
    if dataset in ("agency", "trips"):
        sql += f" UNION ALL SELECT *, DATE '2025-12-29' FROM ({cleaning.typed_sql(dataset)})"
    return sql


add(
    "w10_load_relational",
    lambda spark, sf: cleaning.content(_relational(spark, sf)),
    cleaning.content_sql(
        {d: _snapshots_sql(d) for d in schemas.DATASETS},
        {d: [*cleaning.fields(d), "snapshot_date"] for d in schemas.DATASETS},
    ),
)
add(
    "v17_loaded_snapshot_counts",
    lambda spark, sf: quality.snapshot_counts(_relational(spark, sf), "2025-12-29"),
    "SELECT dataset, CASE WHEN dataset IN ('agency', 'trips') THEN rows ELSE 0 END AS rows "
    f"FROM ({PROCESSED_COUNTS})",
)

# --- star load ------------------------------------------------------------


def _newest_of_history(spark, sf):
    """The operator's choice out of the whole history, with the trips it leads to."""
    trips = views.history(spark, sf)["trips"]
    return (
        at_snapshot(trips, warehouse.newest(trips))
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def _star_table(name, *drop):
    return lambda spark, sf: stored.star(spark, sf)[name].drop(*drop)


add(
    "w01_newest_snapshot",
    lambda spark, sf: _newest_of_history(spark, sf),
    "SELECT snapshot_date, count(*) AS trips FROM n_trips GROUP BY 1",
)
add("w02_dim_route", _star_table("dim_route", "route_key"), "SELECT * FROM g_routes")
add("w03_dim_stop", _star_table("dim_stop", "stop_key"), "SELECT * FROM g_stops")
add("w04_dim_service", _star_table("dim_service", "service_key"), "SELECT * FROM s_service")


def _fact_trip(spark, sf):
    """Facts with their keys resolved back to natural ids."""
    star = stored.star(spark, sf)
    routes = star["dim_route"].select("route_key", "route_id")
    services = star["dim_service"].select("service_key", "service_id")
    return (
        star["fact_trip"]
        .join(routes, "route_key")
        .join(services, "service_key")
        .drop("trip_key", "route_key", "service_key")
    )


add("w05_fact_trip", _fact_trip, "SELECT * FROM s_trip")


def _fact_stop_time(spark, sf):
    star = stored.star(spark, sf)
    trips = star["fact_trip"].select("trip_key", "trip_id")
    stops = star["dim_stop"].select("stop_key", "stop_id")
    return (
        star["fact_stop_time"]
        .join(trips, "trip_key")
        .join(stops, "stop_key")
        .drop("stop_time_key", "trip_key", "stop_key")
    )


add(
    "w06_fact_stop_time",
    _fact_stop_time,
    "SELECT * EXCLUDE (route_id, service_id) FROM s_call",
)


def _reloaded(spark, sf):
    """The newest snapshot loaded over a star that already has it, part of it gone.

    Returns the star and the folder of the dimensions before the second load.
    """
    path = scratch_dir(spark, "reload")
    snapshot = views.newest(spark, sf).all()
    warehouse.load_star(spark, snapshot, path)
    before = scratch_dir(spark, "before")
    for name in dimensional.DIMENSION_ROWS:
        tables.read_table(spark, f"{path}/{name}").write.parquet(f"{before}/{name}")
    fewer = snapshot | {
        "trips": snapshot["trips"].where("direction_id = 1"),
        "routes": snapshot["routes"].where("CAST(route_id AS INT) % 2 = 0").withColumn(
            "route_long_name", F.lit("renamed")
        ),
    }
    warehouse.load_star(spark, fewer, path)
    return warehouse.open_star(spark, path), before


def _reload(spark, sf):
    """Rows, distinct keys and kept dimension keys per table."""
    star, before = _reloaded(spark, sf)
    parts = []
    for name in warehouse.STAR:
        key = dimensional.KEYS[name][0]
        kept = (
            star[name].join(tables.read_table(spark, f"{before}/{name}").select(key), key, "left_semi")
            if name in dimensional.DIMENSION_ROWS
            else star[name].limit(0)
        )
        parts.append(
            star[name]
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_distinct(key).alias("distinct_keys"),
            )
            .select(
                F.lit(name).alias("name"),
                "rows",
                "distinct_keys",
                kept.agg(F.count(F.lit(1))).scalar().alias("kept_keys"),
            )
        )
    return union_all(parts)


N_SERVICE = "SELECT * FROM s_service WHERE snapshot_date = (SELECT d FROM newest)"
# Routes that left the feed stay in the dimension, so all trips of direction 1 remain.
N_TRIP = (
    "SELECT * FROM s_trip WHERE direction_id = 1 AND snapshot_date = (SELECT d FROM newest)"
)
add(
    "w07_reload_snapshot",
    _reload,
    union(
        f"SELECT '{name}' AS name, n AS rows, n AS distinct_keys, {kept} AS kept_keys "
        f"FROM (SELECT count(*) AS n FROM ({origin}))"
        for name, origin, kept in (
            ("dim_route", "SELECT * FROM n_routes", "n"),
            ("dim_stop", "SELECT * FROM n_stops", "n"),
            ("dim_service", N_SERVICE, "n"),
            ("fact_trip", N_TRIP, "CAST(0 AS BIGINT)"),
            (
                "fact_stop_time",
                f"SELECT 1 FROM n_stop_times JOIN ({N_TRIP}) USING (trip_id)",
                "CAST(0 AS BIGINT)",
            ),
        )
    ),
)


add(
    "w07_reload_routes",
    lambda spark, sf: _reloaded(spark, sf)[0]["dim_route"].drop("route_key"),
    "SELECT * REPLACE (CASE WHEN CAST(route_id AS INT) % 2 = 0 THEN 'renamed' "
    "ELSE route_long_name END AS route_long_name) FROM n_routes",
)


def _reload_without_facts(spark, sf):
    """A snapshot reloaded with trips of unknown routes: facts go, dimensions stay."""
    path = scratch_dir(spark, "emptied")
    data = views.history(spark, sf)
    warehouse.load_star(spark, data, path, ALL)
    orphans = data["trips"].withColumn("route_id", F.concat(F.lit("no "), "route_id"))
    warehouse.load_star(spark, {**data, "trips": orphans}, path)
    star = warehouse.open_star(spark, path)
    return union_all(
        [
            star[name]
            .groupBy("snapshot_date")
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("name", F.lit(name))
            for name in warehouse.STAR
        ]
    )


add(
    "w07_reload_without_facts",
    _reload_without_facts,
    union(
        f"SELECT snapshot_date, count(*) AS rows, '{name}' AS name FROM {origin} {where} GROUP BY 1"
        for name, origin, where in (
            ("dim_route", "g_routes", ""),
            ("dim_stop", "g_stops", ""),
            ("dim_service", "s_service", ""),
            ("fact_trip", "s_trip", "WHERE snapshot_date <> (SELECT d FROM newest)"),
            ("fact_stop_time", "s_call", "WHERE snapshot_date <> (SELECT d FROM newest)"),
        )
    ),
)


def _read_during_load(spark, sf):
    """Rows per table, and facts without their dimension rows, for a reader from before a load and one from after.

    Both are asked when the load is done; a load that ends before its commit stands between them.
    """
    path = scratch_dir(spark, "versions")
    data = views.history(spark, sf)
    warehouse.load_star_version(spark, data, path, ALL)
    before = versions.open_version(spark, path)
    orphans = data["trips"].withColumn("route_id", F.concat(F.lit("no "), "route_id"))
    versions.stage(spark, path, "fact_trip", before["fact_trip"].limit(0))
    warehouse.load_star_version(spark, {**data, "trips": orphans}, path)
    parts = []
    for reader, star in (("before", before), ("after", versions.open_version(spark, path))):
        lost = star["fact_trip"].join(star["dim_route"], "route_key", "left_anti")
        lost = lost.select("trip_key").unionByName(
            star["fact_stop_time"].join(star["fact_trip"], "trip_key", "left_anti").select("trip_key")
        )
        counted = {**star, "facts without dimension": lost}
        parts += [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(reader).alias("reader"), F.lit(name).alias("name"), "rows")
            for name, df in counted.items()
        ]
    return union_all(parts)


OLD_FACTS = "WHERE snapshot_date <> (SELECT d FROM newest)"
add(
    "w07_read_during_load",
    _read_during_load,
    union(
        f"SELECT '{reader}' AS reader, '{name}' AS name, count(*) AS rows FROM {origin} {where}"
        for reader, facts in (("before", ""), ("after", OLD_FACTS))
        for name, origin, where in (
            ("dim_route", "g_routes", ""),
            ("dim_stop", "g_stops", ""),
            ("dim_service", "s_service", ""),
            ("fact_trip", "s_trip", facts),
            ("fact_stop_time", "s_call", facts),
            ("facts without dimension", "g_routes", "WHERE false"),
        )
    ),
)


def _key_totals(spark, sf):
    star = stored.star(spark, sf)
    return union_all(
        [
            df.groupBy(dimensional.KEYS[name][0])
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("distinct_keys"),
                count_null(dimensional.KEYS[name][0]).alias("null_keys"),
            )
            .withColumn("name", F.lit(name))
            for name, df in star.items()
        ]
    )


add(
    "w08_surrogate_keys",
    _key_totals,
    union(
        f"SELECT '{name}' AS name, count(*) AS rows, count(*) AS distinct_keys, "
        f"CAST(0 AS BIGINT) AS null_keys FROM {origin}"
        for name, origin in (
            ("dim_route", "g_routes"),
            ("dim_stop", "g_stops"),
            ("dim_service", "s_service"),
            ("fact_trip", "s_trip"),
            ("fact_stop_time", "s_call"),
        )
    ),
)
add(
    "w09_load_report",
    lambda spark, sf: warehouse.load_report(spark, stored.star_root(spark, sf)),
    "SELECT 'fact_trip' AS dataset, count(*) AS rows FROM s_trip UNION ALL "
    "SELECT 'fact_stop_time', count(*) FROM s_call",
)
