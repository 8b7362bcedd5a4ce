"""Dashboard cards over the newest snapshot of the star schema.

The newest date comes from the star's folder names, so other partitions are
pruned when the query is planned; without it, from a scalar subquery on the fact
or dimension the card counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.snapshots import Snapshot, at_snapshot, or_newest
from tramline.functions.text import transport_label

Star = dict[str, DataFrame]


def _trips(star: Star, snapshot: Snapshot) -> DataFrame:
    """Trip counts per route key with the route of the same snapshot."""
    snapshot = or_newest(snapshot, star, "fact_trip")
    counts = (
        at_snapshot(star["fact_trip"], snapshot)
        .groupBy("route_key", "snapshot_date")
        .agg(F.count("trip_key").alias("n"))
    )
    routes = at_snapshot(star["dim_route"], snapshot, of=star["fact_trip"])
    return counts.join(routes, ["route_key", "snapshot_date"])


def trips_by_transport(star: Star, snapshot: Snapshot = None) -> DataFrame:
    return (
        _trips(star, snapshot)
        .groupBy("route_type")
        .agg(F.sum("n").alias("total_viajes"))
        .orderBy(F.desc("total_viajes"), F.asc_nulls_last("route_type"))
        .select(
            transport_label(F.col("route_type")).alias("tipo_transporte"), "total_viajes"
        )
    )


def top_lines(star: Star, snapshot: Snapshot = None, n: int = 10) -> DataFrame:
    return (
        _trips(star, snapshot)
        .orderBy(F.desc("n"), "route_id")
        .limit(n)
        .select(
            F.col("route_short_name").alias("linea"),
            F.col("route_long_name").alias("nombre_ruta"),
            F.col("n").alias("total_viajes"),
        )
    )


def _rows(star: Star, name: str, snapshot: Snapshot, label: str) -> DataFrame:
    rows = at_snapshot(star[name], or_newest(snapshot, star, name))
    return rows.agg(F.count(F.lit(1)).alias(label))


def total_trips(star: Star, snapshot: Snapshot = None) -> DataFrame:
    return _rows(star, "fact_trip", snapshot, "total_viajes")


def total_stops(star: Star, snapshot: Snapshot = None) -> DataFrame:
    return _rows(star, "dim_stop", snapshot, "total_paradas")


def total_lines(star: Star, snapshot: Snapshot = None) -> DataFrame:
    return _rows(star, "dim_route", snapshot, "total_lineas")


def top_stops(star: Star, snapshot: Snapshot = None, n: int = 10) -> DataFrame:
    """Grouped by stop key; only the name is printed."""
    snapshot = or_newest(snapshot, star, "fact_stop_time")
    calls = (
        at_snapshot(star["fact_stop_time"], snapshot)
        .groupBy("stop_key", "snapshot_date")
        .agg(F.count(F.lit(1)).alias("total_pasos"))
    )
    stops = at_snapshot(star["dim_stop"], snapshot, of=star["fact_stop_time"])
    return (
        calls.join(stops, ["stop_key", "snapshot_date"])
        .orderBy(F.desc("total_pasos"), "stop_id")
        .limit(n)
        .select(F.col("stop_name").alias("parada"), "total_pasos")
    )
