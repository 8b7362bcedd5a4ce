"""Exploratory tables over the typed dirty feed and the newest clean snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import cleaning, views
from checks.registry import add
from tramline import schemas
from tramline.operators import profile

ALL_TABLES = schemas.DATASETS


def _typed(plan, *datasets):
    return lambda spark, sf: plan(views.typed_feed(spark, sf, datasets or ALL_TABLES))


def _one(plan, dataset):
    return lambda spark, sf: plan(views.typed_feed(spark, sf, [dataset])[dataset])


def _clean(plan, dataset=None):
    def build(spark, sf):
        tables = views.newest(spark, sf)
        return plan(tables[dataset] if dataset else tables)

    return build


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def _types(dataset):
    return [(f.name, f.dataType.simpleString()) for f in schemas.feed_schema(dataset)]


add(
    "p01_head",
    _clean(lambda df: profile.head(df, "trip_id"), "trips"),
    "SELECT * FROM n_trips ORDER BY trip_id LIMIT 5",
)
for name, order in (
    ("agency", "agency_name"),
    ("routes", "route_id"),
    ("stops", "stop_id"),
    ("calendar", "service_id"),
):
    add(
        f"p01_head_{name}",
        _clean(lambda df, o=order: profile.head(df, o), name),
        f"SELECT * FROM g_{name} WHERE snapshot_date = (SELECT d FROM newest) ORDER BY {order} LIMIT 5",
    )
add(
    "p01_head_stop_times",
    _clean(lambda df: profile.head(df, "trip_id", "stop_sequence", "stop_id"), "stop_times"),
    "SELECT * FROM n_stop_times ORDER BY trip_id, stop_sequence, stop_id LIMIT 5",
)
add(
    "p01_shape",
    _typed(profile.shape),
    union(
        f"SELECT '{d}' AS dataset, '{c}' AS column_name, '{t}' AS data_type, "
        f"(SELECT count(*) FROM t_{d}) AS filas, {len(_types(d))} AS columnas"
        for d in ALL_TABLES
        for c, t in _types(d)
    ),
)


def describe_sql(dataset: str) -> str:
    def one(column: str) -> str:
        freq = (
            f"SELECT CAST({column} AS STRING) AS v, count(*) AS n FROM t_{dataset} "
            f"WHERE {column} IS NOT NULL GROUP BY 1"
        )
        return (
            f"SELECT '{column}' AS column_name, "
            f"CAST(coalesce((SELECT sum(n) FROM ({freq})), 0) AS BIGINT) AS count, "
            f'(SELECT count(*) FROM ({freq})) AS "unique", '
            f"(SELECT v FROM ({freq}) ORDER BY n DESC, v LIMIT 1) AS top, "
            f"(SELECT max(n) FROM ({freq})) AS freq"
        )

    return union(one(c) for c in cleaning.fields(dataset))


for name in schemas.TEXT_DATASETS:
    add(f"p02_describe_{name}", _one(profile.describe_text, name), describe_sql(name))

add(
    "p03_volumes",
    _typed(profile.volumes),
    union(
        f"SELECT '{d}' AS dataset, count(*) AS filas, {len(_types(d))} AS columnas FROM t_{d}"
        for d in ALL_TABLES
    ),
)


def _null(c: str) -> str:
    return f"count(*) FILTER (WHERE {c} IS NULL)"


add(
    "p04_null_cells",
    _typed(profile.null_cells),
    union(
        f"SELECT '{d}' AS dataset, '{c}' AS column_name, {_null(c)} AS nulls, "
        f"{' + '.join(_null(x) for x in cleaning.fields(d))} AS total_nulls FROM t_{d}"
        for d in ALL_TABLES
        for c in cleaning.fields(d)
    ),
)
add(
    "p05_routes_per_type",
    _one(profile.routes_per_type, "routes"),
    "SELECT route_type, count(*) AS num_rutas FROM t_routes "
    "WHERE route_type IS NOT NULL GROUP BY 1",
)
add(
    "p06_first_routes",
    _clean(profile.first_routes, "routes"),
    "SELECT route_short_name, route_long_name, route_type FROM n_routes "
    "ORDER BY route_short_name, route_id LIMIT 20",
)
add(
    "p07_stops_without_coordinates",
    lambda spark, sf: profile.stops_without_coordinates(views.dirty(spark, sf, "stops")),
    "SELECT count(*) AS paradas_sin_coordenadas FROM d_stops WHERE stop_lat IS NULL "
    "OR stop_lon IS NULL OR stop_lat = '' OR stop_lon = ''",
)
add(
    "p08_repeated_stop_ids",
    _one(profile.repeated_stop_ids, "stops"),
    "SELECT count(*) - count(DISTINCT row(stop_id)) AS stop_id_duplicados FROM t_stops",
)


def gap_rows(child: str, key: str, parent: str, prefix: str) -> str:
    gaps = (
        f"SELECT {key}, count(*) AS n FROM {prefix}{child} c WHERE NOT EXISTS (SELECT 1 FROM "
        f"{prefix}{parent} p WHERE p.{key} IS NOT DISTINCT FROM c.{key}) GROUP BY 1"
    )
    return (
        f"SELECT '{child}.{key}' AS referencia, count(*) AS ids_sin_correspondencia, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS filas_sin_correspondencia FROM ({gaps})"
    )


GAP_TABLES = ("routes", "trips", "stops", "stop_times")


def _raw_gaps(*columns):
    return _typed(
        lambda t: profile.reference_gaps(t).select("referencia", *columns), *GAP_TABLES
    )


RAW_GAPS = union(gap_rows(*r, "t_") for r in schemas.REFERENCES)
add(
    "p09_reference_gap_ids",
    _raw_gaps("ids_sin_correspondencia"),
    f"SELECT referencia, ids_sin_correspondencia FROM ({RAW_GAPS})",
)
add(
    "p10_reference_gap_rows",
    _raw_gaps("filas_sin_correspondencia"),
    f"SELECT referencia, filas_sin_correspondencia FROM ({RAW_GAPS})",
)
add(
    "p10_final_reference_gap_rows",
    lambda spark, sf: profile.reference_gaps(
        cleaning.clean.clean_text_feed(cleaning._text_feed(spark, sf))
    ),
    union(gap_rows(*r, "x_") for r in schemas.REFERENCES),
    **{f"x_{d}": cleaning.text_rules_sql(d) for d in GAP_TABLES},
)
PER_ROUTE = (
    "SELECT route_id, count(*) AS num_trips FROM g_trips WHERE route_id IS NOT NULL GROUP BY 1"
)


def _all_trips(plan):
    return lambda spark, sf: plan(views.history(spark, sf)["trips"])


add(
    "p11_trips_per_route",
    _all_trips(profile.trips_per_route_stats),
    "SELECT round(avg(num_trips), 2) AS media, max(num_trips) AS maximo, "
    f"min(num_trips) AS minimo FROM ({PER_ROUTE})",
)
add(
    "p12_coordinate_range",
    lambda spark, sf: profile.coordinate_range(views.dirty(spark, sf, "stops")),
    "SELECT count(*) FILTER (WHERE stop_lat IS NULL) AS sin_latitud, "
    "count(*) FILTER (WHERE stop_lon IS NULL) AS sin_longitud, "
    "min(TRY_CAST(stop_lat AS DOUBLE)) AS lat_min, max(TRY_CAST(stop_lat AS DOUBLE)) AS lat_max, "
    "min(TRY_CAST(stop_lon AS DOUBLE)) AS lon_min, max(TRY_CAST(stop_lon AS DOUBLE)) AS lon_max "
    "FROM d_stops",
)

COLORS = {
    1: "CASE route_short_name "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in schemas.METRO_COLORS.items())
    + f" ELSE '{schemas.METRO_OTHER}' END",
    3: "CASE "
    + " ".join(
        f"WHEN route_short_name LIKE '{k}%' THEN '{v}'"
        for k, v in schemas.BUS_PREFIX_COLORS.items()
    )
    + f" ELSE '{schemas.BUS_OTHER}' END",
}


def network_sql(route_type: int) -> str:
    return (
        "SELECT stop_id, stop_name, stop_lat, stop_lon, "
        "count(DISTINCT route_short_name) AS route_count, "
        "string_agg(DISTINCT route_short_name, ', ' ORDER BY route_short_name) AS routes, "
        "string_agg(color, ', ' ORDER BY color) AS colors, "
        "CASE WHEN count(DISTINCT route_short_name) = 1 THEN min(color) "
        f"ELSE '{schemas.SHARED_STOP_COLOR}' END AS display_color "
        f"FROM (SELECT DISTINCT stop_id, route_id, route_short_name, {COLORS[route_type]} AS color "
        "FROM n_stop_times JOIN n_trips USING (trip_id) JOIN n_routes USING (route_id) "
        f"WHERE route_type = {route_type}) JOIN n_stops USING (stop_id) GROUP BY 1, 2, 3, 4"
    )


def _network(plan):
    def build(spark, sf):
        stops = plan(views.newest(spark, sf))
        return stops.withColumn("colors", F.array_join("colors", ", "))

    return build


add("p13_metro_stops", _network(profile.metro_stops), network_sql(1))
add("p14_bus_stops", _network(profile.bus_stops), network_sql(3))
for label, plan, route_type in (
    ("metro", profile.metro_stops, 1),
    ("bus", profile.bus_stops, 3),
):
    add(
        f"p15_{label}_totals",
        _clean(lambda t, p=plan: profile.network_totals(p(t))),
        "SELECT count(*) AS paradas, count(*) FILTER (WHERE route_count = 1) AS una_linea, "
        "count(*) FILTER (WHERE route_count > 1) AS varias_lineas "
        f"FROM ({network_sql(route_type)})",
    )
add(
    "p16_route_types",
    _clean(
        lambda routes: profile.route_type_distribution(
            routes.withColumn("route_type", F.expr("route_type + CAST(route_id AS INT) % 3"))
        ),
        "routes",
    ),
    "SELECT CASE k WHEN 0 THEN 'Tranvía' WHEN 1 THEN 'Metro' WHEN 2 THEN 'Ferrocarril' "
    "WHEN 3 THEN 'Bus' WHEN 4 THEN 'Ferry' WHEN 5 THEN 'Teleférico' WHEN 6 THEN 'Telecabina' "
    "WHEN 7 THEN 'Funicular' ELSE 'Tipo ' || CAST(k AS STRING) END AS tipo, "
    "count(*) AS num_rutas FROM (SELECT route_type + CAST(route_id AS INT) % 3 AS k "
    "FROM n_routes) GROUP BY k",
)


add(
    "p17_top_routes",
    _clean(profile.top_routes),
    "SELECT route_short_name, route_long_name, num_trips, "
    "coalesce(route_short_name, t.route_id) AS etiqueta "
    "FROM (SELECT route_id, count(*) AS num_trips FROM n_trips GROUP BY 1) t "
    "LEFT JOIN n_routes r "
    "ON r.route_id = t.route_id ORDER BY num_trips DESC, t.route_id LIMIT 20",
)
add(
    "p18_trips_histogram",
    _all_trips(profile.trips_histogram),
    "SELECT bin, count(*) AS num_rutas FROM (SELECT CASE WHEN hi = lo THEN 11 ELSE "
    "least(20, 1 + CAST(floor((num_trips - lo) * 20.0 / (hi - lo)) AS INT)) END AS bin "
    f"FROM ({PER_ROUTE}), (SELECT min(num_trips) AS lo, max(num_trips) AS hi "
    f"FROM ({PER_ROUTE}))) GROUP BY 1",
)
TRIP_COUNTS = (
    "SELECT r.*, CAST(coalesce(n, 0) AS INT) AS trip_count "
    "FROM (SELECT DISTINCT * FROM t_routes) r LEFT JOIN (SELECT route_id, count(*) AS n "
    "FROM (SELECT DISTINCT * FROM t_trips) GROUP BY 1) t ON t.route_id = r.route_id"
)
add(
    "p20_route_trip_counts",
    _typed(profile.route_trip_counts, "routes", "trips"),
    TRIP_COUNTS,
)
add(
    "p20_top_route_trip_counts",
    _typed(profile.top_route_trip_counts, "routes", "trips"),
    f"SELECT route_short_name, trip_count FROM ({TRIP_COUNTS}) "
    "ORDER BY trip_count DESC, route_id NULLS FIRST LIMIT 10",
)
