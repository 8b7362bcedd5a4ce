"""Star-schema frames: dimension upserts and fact joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline import schemas

Tables = Mapping[str, DataFrame]

# dimension or fact -> (surrogate key, natural key)
KEYS = {
    "dim_route": ("route_key", ["route_id", "snapshot_date"]),
    "dim_stop": ("stop_key", ["stop_id", "snapshot_date"]),
    "dim_service": ("service_key", ["service_id", "snapshot_date"]),
    "fact_trip": ("trip_key", ["trip_id", "snapshot_date"]),
    "fact_stop_time": ("stop_time_key", []),
}


def next_key(above: int) -> Column:
    """A new surrogate key per row, above every key given out so far.

    Numbers come from the task index and the position within the task: unique
    without a shuffle, a global sort or a second pass. They are final once the
    table is written, so readers of the key must read the written table.
    """
    return F.monotonically_increasing_id() + (above + 1)


def gathered(df: DataFrame, balance: bool = True) -> DataFrame:
    """Rows of one snapshot side by side, large snapshots split over several tasks.

    A shuffle of all rows, for frames of many snapshots only.
    """
    return df.hint("rebalance", "snapshot_date") if balance else df


def route_rows(tables: Tables) -> DataFrame:
    return tables["routes"].select(*schemas.FEED["routes"], "snapshot_date")


def stop_rows(tables: Tables) -> DataFrame:
    return tables["stops"].select(*schemas.FEED["stops"], "snapshot_date")


def service_rows(tables: Tables) -> DataFrame:
    """Calendar services, plus services known only by exception date and used by a trip.

    Trips shrink to their distinct services first; there are few, however many
    trips run under one of them.
    """
    key = ["service_id", "snapshot_date"]
    calendar = tables["calendar"].select(
        "service_id", *schemas.WEEKDAYS, "start_date", "end_date", "snapshot_date"
    )
    dated = (
        tables["calendar_dates"]
        .select(*key)
        .distinct()
        .join(calendar.select(*key), key, "left_anti")
        .join(tables["trips"].select(*key).distinct(), key, "left_semi")
    )
    return calendar.unionByName(dated, allowMissingColumns=True)


DIMENSION_ROWS = {
    "dim_route": route_rows,
    "dim_stop": stop_rows,
    "dim_service": service_rows,
}


def upsert(
    stored: DataFrame | None,
    incoming: DataFrame,
    key: str,
    natural: Sequence[str],
    above: int = 0,
    balance: bool = False,
) -> DataFrame:
    """Incoming rows with the key of the stored row they replace, or a new key.

    Stored rows without a successor stay. ``stored`` is the part of the table that
    can match (one snapshot of the history); new keys start above ``above``.
    ``balance`` gathers each snapshot's rows for the write. That happens before
    keys are numbered, so that the writing task numbers them.
    """
    columns = [key, *incoming.columns]
    if stored is None:
        rows = gathered(incoming, balance)
        return rows.withColumn(key, next_key(above)).select(*columns)
    old = stored.select(*(F.col(c).alias(f"old_{c}") for c in columns))
    new = incoming.withColumn("_arrived", F.lit(True))
    on = [new[c] == old[f"old_{c}"] for c in natural]
    merged = gathered(new.join(old, on, "full_outer"), balance)
    merged = merged.withColumn("_next", next_key(above))
    arrived = F.col("_arrived").isNotNull()
    return merged.select(
        F.coalesce(f"old_{key}", "_next").alias(key),
        *(
            F.when(arrived, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
            for c in incoming.columns
        ),
    )


def trip_facts(trips: DataFrame, dim_route: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Trips with the keys of their route and service; trips lacking either vanish.

    Routes, like trips and stops below, grow with the feed: they are merged at every
    size, so the driver never holds one of them as a broadcast.
    """
    routes = dim_route.select("route_id", "snapshot_date", "route_key").hint("merge")
    services = dim_service.select("service_id", "snapshot_date", "service_key")
    return (
        trips.join(services, ["service_id", "snapshot_date"])
        .join(routes, ["route_id", "snapshot_date"])
        .select(
            "trip_id",
            "route_key",
            "service_key",
            "trip_headsign",
            "direction_id",
            "shape_id",
            "wheelchair_accessible",
            "snapshot_date",
        )
    )


def stop_time_facts(
    stop_times: DataFrame, fact_trip: DataFrame, dim_stop: DataFrame, by_trip: bool = False
) -> DataFrame:
    """Calls with the keys of their trip and stop; calls lacking either vanish.

    ``by_trip`` is for calls that lie by ``trip_id``: trips come first, joined by id,
    and the date is compared behind that join instead of being a part of its key,
    so the calls stay where they are until they meet their stops.
    """
    trips = fact_trip.select("trip_id", "snapshot_date", "trip_key").hint("merge")
    stops = dim_stop.select("stop_id", "snapshot_date", "stop_key").hint("merge")
    if by_trip:
        trips = trips.withColumnRenamed("snapshot_date", "_of")
        same_day = F.datediff("snapshot_date", "_of") == 0
        calls = stop_times.join(trips, (stop_times["trip_id"] == trips["trip_id"]) & same_day)
        calls = calls.drop(trips["trip_id"]).join(stops, ["stop_id", "snapshot_date"])
    else:
        calls = stop_times.join(stops, ["stop_id", "snapshot_date"]).join(trips, ["trip_id", "snapshot_date"])
    return calls.select(
        "trip_key",
        "stop_key",
        "arrival_time",
        "departure_time",
        "stop_sequence",
        "snapshot_date",
    )
