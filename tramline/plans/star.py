"""Queries over the star schema.

``star`` maps table names to frames; restrict it with ``open_star(snapshot=…)``
to query one snapshot, else the whole history counts.

``trip_key`` and ``stop_time_key`` identify fact rows by construction, so a count
of distinct fact keys is a count of rows. That count is taken per dimension key
before the dimension is joined, which folds hot keys on the map side.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.aggregates import union_all

Star = dict[str, DataFrame]
ROUTE_NAMES = ("route_short_name", "route_long_name")


def _count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _total(df: DataFrame, *keys: str, as_name: str = "num_viajes") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias(as_name))


def _trips_by_route(star: Star, *keys: str, as_name: str = "num_viajes") -> DataFrame:
    counts = _count(star["fact_trip"], "route_key")
    return _total(counts.join(star["dim_route"], "route_key"), *keys, as_name=as_name)


def top_routes(star: Star, n: int = 10) -> DataFrame:
    return (
        _trips_by_route(star, "route_id", *ROUTE_NAMES)
        .orderBy(F.desc("num_viajes"), "route_id", *ROUTE_NAMES)
        .limit(n)
    )


def trips_by_route_type(star: Star) -> DataFrame:
    return _trips_by_route(star, "route_type").orderBy(
        F.desc("num_viajes"), F.asc_nulls_last("route_type")
    )


def top_stops_by_calls(star: Star, n: int = 10) -> DataFrame:
    calls = _count(star["fact_stop_time"], "stop_key")
    return (
        _total(
            calls.join(star["dim_stop"], "stop_key"),
            "stop_id",
            "stop_name",
            as_name="num_pasos",
        )
        .orderBy(F.desc("num_pasos"), "stop_id", "stop_name")
        .limit(n)
    )


def top_route_names_by_stops(star: Star, n: int = 10) -> DataFrame:
    """Grouped by route names, so equally named routes share their stops.

    The least key of equally named routes stands for their names. Trips take it
    before they meet their calls, so calls are moved as pairs of keys: once to
    their trips and once to become distinct.
    """
    routes = star["dim_route"].select("route_key", *ROUTE_NAMES)
    named = routes.groupBy(*ROUTE_NAMES).agg(F.min("route_key").alias("named"))
    least = [routes[c].eqNullSafe(named[c]) for c in ROUTE_NAMES]
    keys = routes.join(named, reduce(and_, least)).select("route_key", "named")
    trips = star["fact_trip"].select("trip_key", "route_key").join(keys, "route_key").select("trip_key", "named")
    pairs = (
        star["fact_stop_time"]
        .select("trip_key", "stop_key")
        .join(trips, "trip_key")
        .select("named", "stop_key")
        .distinct()
    )
    return (
        pairs.groupBy("named")
        .agg(F.count(F.lit(1)).alias("num_paradas"))
        .join(named, "named")
        .select(*ROUTE_NAMES, "num_paradas")
        .orderBy(F.desc("num_paradas"), *ROUTE_NAMES)
        .limit(n)
    )


def trips_by_direction(star: Star) -> DataFrame:
    return (
        star["fact_trip"]
        .groupBy("direction_id")
        .agg(F.count(F.lit(1)).alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), F.asc_nulls_last("direction_id"))
    )


def top_services(star: Star, n: int = 20) -> DataFrame:
    counts = _count(star["fact_trip"], "service_key")
    return (
        _total(counts.join(star["dim_service"], "service_key"), "service_id")
        .orderBy(F.desc("num_viajes"), "service_id")
        .limit(n)
    )


def routes_by_type(star: Star) -> DataFrame:
    return (
        star["dim_route"]
        .groupBy("route_type")
        .agg(F.count("route_key").alias("num_rutas"))
        .orderBy(F.desc("num_rutas"), F.asc_nulls_last("route_type"))
    )


def trips_by_route_and_service(star: Star) -> DataFrame:
    """All (route name, service) pairs, sorted by route and busiest service."""
    return _route_service(star).orderBy(
        F.asc_nulls_last("route_short_name"), F.desc("num_viajes"), "service_id"
    )


def top_route_service_pairs(star: Star, n: int = 10) -> DataFrame:
    return (
        _route_service(star)
        .orderBy(F.desc("num_viajes"), F.asc_nulls_last("route_short_name"), "service_id")
        .limit(n)
    )


def _route_service(star: Star) -> DataFrame:
    counts = _count(star["fact_trip"], "route_key", "service_key")
    return _total(
        counts.join(star["dim_route"], "route_key").join(
            star["dim_service"], "service_key"
        ),
        "route_short_name",
        "service_id",
    )


def trips_by_route_and_direction(star: Star) -> DataFrame:
    counts = _count(star["fact_trip"], "route_key", "direction_id")
    return _total(
        counts.join(star["dim_route"], "route_key"), "route_short_name", "direction_id"
    ).orderBy(
        F.asc_nulls_last("route_short_name"),
        F.desc("num_viajes"),
        F.asc_nulls_last("direction_id"),
    )


def service_usage(star: Star) -> DataFrame:
    """Routes and trips per service, without a multi-distinct expansion."""
    counts = _count(star["fact_trip"], "service_key", "route_key")
    pairs = _total(
        counts.join(star["dim_service"], "service_key"),
        "service_id",
        "route_key",
        as_name="n",
    )
    return (
        pairs.groupBy("service_id")
        .agg(F.count(F.lit(1)).alias("num_rutas"), F.sum("n").alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), "service_id")
    )


def trips_by_weekday(star: Star) -> DataFrame:
    """Trips of services active on each weekday: one pass, seven conditional sums."""
    counts = _count(star["fact_trip"], "service_key").join(
        star["dim_service"], "service_key"
    )
    sums = counts.agg(
        *(
            F.coalesce(F.sum(F.when(F.col(day) == 1, F.col("n"))), F.lit(0)).alias(name)
            for day, name in schemas.DAY_NAMES.items()
        )
    )
    return sums.unpivot(
        [], list(schemas.DAY_NAMES.values()), "dia_semana", "num_viajes"
    )


def top_stops_by_trips(star: Star, n: int = 10) -> DataFrame:
    """Distinct trips per stop. A trip may call twice, so pairs are folded first."""
    pairs = star["fact_stop_time"].select("stop_key", "trip_key").distinct()
    return (
        _total(
            _count(pairs, "stop_key").join(star["dim_stop"], "stop_key"),
            "stop_id",
            "stop_name",
        )
        .orderBy(F.desc("num_viajes"), "stop_id", "stop_name")
        .limit(n)
    )


def stops_by_location_type(star: Star) -> DataFrame:
    return _stops_by(star, "location_type")


def stops_by_wheelchair(star: Star) -> DataFrame:
    return _stops_by(star, "wheelchair_boarding")


def _stops_by(star: Star, column: str) -> DataFrame:
    return (
        star["dim_stop"]
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("num_paradas"))
        .orderBy(F.desc("num_paradas"), F.asc_nulls_last(column))
    )


def route_workload(star: Star, n: int = 20) -> DataFrame:
    """Trips with calls, and calls, per route name.

    Calls are counted per trip before the join; both joins then work on one row
    per trip or route, and no distinct is left.
    """
    calls = _count(star["fact_stop_time"], "trip_key")
    per_route = (
        calls.join(star["fact_trip"].select("trip_key", "route_key"), "trip_key")
        .groupBy("route_key")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("n").alias("calls"))
    )
    return (
        per_route.join(star["dim_route"], "route_key")
        .groupBy(*ROUTE_NAMES)
        .agg(
            F.sum("trips").alias("num_viajes"),
            F.sum("calls").alias("num_paradas_recorridas"),
        )
        .orderBy(F.desc("num_viajes"), *ROUTE_NAMES)
        .limit(n)
    )


def service_active_days(star: Star) -> DataFrame:
    active = sum((F.coalesce(day, F.lit(0)) for day in schemas.WEEKDAYS), F.lit(0))
    return (
        star["dim_service"]
        .select(
            "service_id",
            "start_date",
            "end_date",
            active.cast("int").alias("dias_activos"),
            "snapshot_date",
        )
        .orderBy(F.desc("dias_activos"), "service_id", "snapshot_date")
        .drop("snapshot_date")
    )


def table_totals(star: Star) -> DataFrame:
    """Rows of each table in one row; five metadata-cheap counts."""
    names = {
        "total_rutas": "dim_route",
        "total_paradas": "dim_stop",
        "total_servicios": "dim_service",
        "total_viajes": "fact_trip",
        "total_stop_times": "fact_stop_time",
    }
    counts = union_all(
        [
            star[table].agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(label))
            for label, table in names.items()
        ]
    )
    return counts.agg(
        *(F.max(F.when(F.col("name") == label, F.col("n"))).alias(label) for label in names)
    )


def model_totals(star: Star) -> DataFrame:
    """Distinct members and rows of the full star join in one row.

    Dimension keys are unique, so joining a dimension only asks whether the key
    exists. Calls are folded per trip and trips per (route, service) before that
    is asked, instead of a four-way distinct over all calls. Stops are made
    distinct before they meet their dimension, so that a hot stop is one row.
    """
    stops = star["dim_stop"].select("stop_key")
    routes = star["dim_route"].select("route_key")
    services = star["dim_service"].select("service_key")
    trips = star["fact_trip"].select("trip_key", "route_key", "service_key")
    calls = star["fact_stop_time"].select("trip_key", "stop_key")

    per_trip = _count(calls.join(stops, "stop_key", "left_semi"), "trip_key")
    pairs = (
        per_trip.join(trips, "trip_key")
        .groupBy("route_key", "service_key")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("n").alias("calls"))
        .join(routes, "route_key", "left_semi")
        .join(services, "service_key", "left_semi")
    )
    whole = trips.join(routes, "route_key", "left_semi").join(
        services, "service_key", "left_semi"
    )
    used = (
        calls.join(whole.select("trip_key"), "trip_key", "left_semi")
        .select("stop_key")
        .distinct()
        .join(stops, "stop_key", "left_semi")
    )
    return pairs.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("total_viajes"),
        F.count_distinct("route_key").alias("total_rutas"),
        F.count_distinct("service_key").alias("total_servicios"),
        F.coalesce(F.sum("calls"), F.lit(0)).alias("total_stop_times"),
    ).select(
        "total_viajes",
        "total_rutas",
        used.agg(F.count(F.lit(1))).scalar().alias("total_paradas"),
        "total_servicios",
        "total_stop_times",
    )


def top_routes_by_key(star: Star, n: int = 10) -> DataFrame:
    return (
        _trips_by_route(star, "route_key", "route_short_name", "route_id", "snapshot_date",
                        as_name="total_viajes")
        .orderBy(F.desc("total_viajes"), "route_id", "snapshot_date")
        .limit(n)
        .select("route_short_name", "total_viajes")
    )
