"""Queries over the relational tables of one snapshot (default: the newest).

Counts are taken per id before names are joined on. A route or stop that holds a
large share of the rows is then folded on the map side, and the join sees one
row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.snapshots import Snapshot, at_snapshot, or_newest
from tramline.functions.text import transport_label

Tables = dict[str, DataFrame]


def scoped(tables: Tables, snapshot: Snapshot, *names: str) -> list[DataFrame]:
    """The named tables at one snapshot, the newest being that of the trips."""
    snapshot = or_newest(snapshot, tables, "trips")
    return [at_snapshot(tables[n], snapshot, of=tables["trips"]) for n in names]


def _per_route(routes: DataFrame, trips: DataFrame) -> DataFrame:
    counts = trips.groupBy("route_id").agg(F.count("trip_id").alias("n"))
    return counts.join(routes, "route_id")


def top_routes_by_trips(
    tables: Tables, snapshot: Snapshot = None, n: int = 10
) -> DataFrame:
    routes, trips = scoped(tables, snapshot, "routes", "trips")
    names = ["route_id", "route_short_name", "route_long_name"]
    return (
        _per_route(routes, trips)
        .groupBy(*names)
        .agg(F.sum("n").alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), "route_id")
        .limit(n)
        .select("route_short_name", "route_long_name", "num_viajes")
    )


def trips_by_transport(tables: Tables, snapshot: Snapshot = None) -> DataFrame:
    """Grouped by type code, so several codes can print the same label."""
    routes, trips = scoped(tables, snapshot, "routes", "trips")
    return (
        _per_route(routes, trips)
        .groupBy("route_type")
        .agg(F.sum("n").alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), F.asc_nulls_last("route_type"))
        .select(transport_label(F.col("route_type")).alias("tipo_transporte"), "num_viajes")
    )


def top_stops_by_calls(
    tables: Tables, snapshot: Snapshot = None, n: int = 10
) -> DataFrame:
    stops, stop_times = scoped(tables, snapshot, "stops", "stop_times")
    calls = stop_times.groupBy("stop_id").agg(F.count("trip_id").alias("n"))
    return (
        calls.join(stops, "stop_id")
        .groupBy("stop_id", "stop_name")
        .agg(F.sum("n").alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), "stop_id")
        .limit(n)
    )


def top_routes_by_stops(
    tables: Tables, snapshot: Snapshot = None, n: int = 10
) -> DataFrame:
    """Routes by distinct stops; pairs are made distinct before names are joined on."""
    routes, trips, stop_times = scoped(tables, snapshot, "routes", "trips", "stop_times")
    pairs = (
        stop_times.select("trip_id", "stop_id")
        .join(trips.select("trip_id", "route_id"), "trip_id")
        .select("route_id", "stop_id")
        .distinct()
    )
    counts = pairs.groupBy("route_id").agg(F.count("stop_id").alias("num_paradas"))
    return (
        counts.join(
            routes.select("route_id", "route_short_name", "route_long_name").distinct(),
            "route_id",
        )
        .orderBy(F.desc("num_paradas"), "route_id", "route_short_name", "route_long_name")
        .limit(n)
        .select("route_short_name", "route_long_name", "num_paradas")
    )


def trips_by_direction(tables: Tables, snapshot: Snapshot = None) -> DataFrame:
    (trips,) = scoped(tables, snapshot, "trips")
    return (
        trips.groupBy("direction_id")
        .agg(F.count(F.lit(1)).alias("num_viajes"))
        .orderBy(F.asc_nulls_last("direction_id"))
    )


def calendar_exceptions(tables: Tables, snapshot: Snapshot = None) -> DataFrame:
    (dates,) = scoped(tables, snapshot, "calendar_dates")
    return (
        dates.groupBy("exception_type")
        .agg(F.count(F.lit(1)).alias("num_registros"))
        .orderBy(F.asc_nulls_last("exception_type"))
    )


def top_services(tables: Tables, snapshot: Snapshot = None, n: int = 10) -> DataFrame:
    (trips,) = scoped(tables, snapshot, "trips")
    return (
        trips.groupBy("service_id")
        .agg(F.count(F.lit(1)).alias("num_viajes"))
        .orderBy(F.desc("num_viajes"), F.asc_nulls_last("service_id"))
        .limit(n)
    )
