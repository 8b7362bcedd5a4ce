"""Metrics over the stored arrival predictions.

A bus is predicted again at every poll and stored each time; the metrics count
predictions. ``as_of`` is the end of the window: a timestamp, ``NEWEST`` for the
newest stored prediction, or None for the current time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.snapshots import at_snapshot, or_newest

NEWEST = "newest"
AsOf = dt.datetime | str | None


def last_hour(arrivals: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Predictions of the hour before ``as_of``; the bounds are pushed into the scan.

    A given time ends the window, on the day and the time. The present and the
    newest prediction need no end. On a table with ``event_date`` partitions only the days of that hour are read.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    daily = "event_date" in arrivals.columns
    if as_of is None:
        start = F.current_timestamp() - hour
    elif isinstance(as_of, str) and as_of == NEWEST:
        last = arrivals
        if daily:
            day = arrivals.select(F.max("event_date")).scalar()
            last = arrivals.where(F.col("event_date") == day)
        start = last.select(F.max("event_timestamp") - hour).scalar()
    else:
        start = F.lit(as_of) - hour
    recent = arrivals.where(F.col("event_timestamp") >= start)
    if daily:
        recent = recent.where(F.col("event_date") >= F.to_date(start))
    if as_of is not None and as_of != NEWEST:
        recent = recent.where(F.col("event_timestamp") <= F.lit(as_of))
        if daily:
            recent = recent.where(F.col("event_date") <= F.to_date(F.lit(as_of)))
    return recent


def arrivals_per_line(arrivals: DataFrame, as_of: AsOf = None) -> DataFrame:
    return all_arrivals_per_line(last_hour(arrivals, as_of))


def all_arrivals_per_line(arrivals: DataFrame) -> DataFrame:
    return (
        arrivals.groupBy("line")
        .agg(F.count(F.lit(1)).alias("total_llegadas"))
        .orderBy(F.desc("total_llegadas"), F.asc_nulls_last("line"))
    )


def arrivals_per_minute(arrivals: DataFrame, as_of: AsOf = None) -> DataFrame:
    kind = arrivals.schema["event_timestamp"].dataType
    minute = F.date_trunc("minute", "event_timestamp").cast(kind)
    return (
        last_hour(arrivals, as_of)
        .groupBy(minute.alias("minuto"))
        .agg(F.count(F.lit(1)).alias("total_llegadas"))
        .orderBy("minuto")
    )


def waiting_time_per_line(arrivals: DataFrame, as_of: AsOf = None) -> DataFrame:
    return (
        last_hour(arrivals, as_of)
        .groupBy("line")
        .agg(
            F.round(F.avg("arrival_seconds"), 6).alias("media_segundos"),
            F.min("arrival_seconds").alias("minimo_segundos"),
            F.max("arrival_seconds").alias("maximo_segundos"),
        )
        .orderBy(F.desc_nulls_first("media_segundos"), F.asc_nulls_last("line"))
    )


def busiest_stops(arrivals: DataFrame, as_of: AsOf = None, n: int = 10) -> DataFrame:
    return (
        last_hour(arrivals, as_of)
        .groupBy("stop_id")
        .agg(F.count(F.lit(1)).alias("total_llegadas"))
        .orderBy(F.desc("total_llegadas"), F.asc_nulls_last("stop_id"))
        .limit(n)
    )


def current_state(arrivals: DataFrame, as_of: AsOf = None) -> DataFrame:
    return last_hour(arrivals, as_of).agg(
        F.count(F.lit(1)).alias("total_llegadas"),
        F.count_distinct("line").alias("lineas_activas"),
        F.count_distinct("stop_id").alias("paradas_activas"),
        F.round(F.avg("arrival_seconds"), 6).alias("media_segundos"),
    )


def newest_snapshot_summary(star: dict[str, DataFrame]) -> DataFrame:
    """Trips, routes and services of the newest loaded snapshot."""
    trips = at_snapshot(star["fact_trip"], or_newest(None, star, "fact_trip"))
    pairs = trips.groupBy("snapshot_date", "route_key", "service_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    return pairs.groupBy("snapshot_date").agg(
        F.sum("n").alias("total_viajes"),
        F.count_distinct("route_key").alias("total_rutas"),
        F.count_distinct("service_key").alias("total_servicios"),
    )


def latest_arrivals(arrivals: DataFrame, n: int = 20) -> DataFrame:
    """The newest predictions.

    On a table with ``event_date`` partitions only the newest days that hold
    ``n`` rows together are read; rows per day come from the files' footers.
    """
    if "event_date" in arrivals.columns:
        days = arrivals.where("event_date IS NOT NULL").groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))
        later = Window.orderBy(F.desc("event_date")).rowsBetween(Window.unboundedPreceding, -1)
        days = days.withColumn("before", F.coalesce(F.sum("rows").over(later), F.lit(0)))
        first = days.where(F.col("before") < n).agg(F.min("event_date")).scalar()
        arrivals = arrivals.where(F.col("event_date") >= first)
    return arrivals.orderBy(
        F.desc("event_timestamp"),
        F.asc_nulls_last("line"),
        F.asc_nulls_last("stop_id"),
        F.asc_nulls_last("route_id"),
        F.asc_nulls_last("arrival_seconds"),
    ).limit(n)
