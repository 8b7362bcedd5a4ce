"""Exploratory tables over a snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.aggregates import (
    count_null,
    count_true,
    orphan_rows,
    surplus_rows,
    union_all,
)
from tramline.functions.text import bus_color, metro_color, route_type_name

Datasets = Mapping[str, DataFrame]


def _cells(df: DataFrame) -> DataFrame:
    """``column_name, value`` with every cell as text, in column order."""
    texts = df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))
    return texts.unpivot([], list(df.columns), "column_name", "value")


def head(df: DataFrame, *keys: str, n: int = 5) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def shape(datasets: Datasets) -> DataFrame:
    """Per column: its type, with the row and column count of its dataset."""
    parts = []
    for name, df in datasets.items():
        columns = F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
                for c, t in df.dtypes
            )
        )
        parts.append(
            df.agg(F.count(F.lit(1)).alias("filas"))
            .select("filas", F.explode(columns).alias("c"))
            .select(
                F.lit(name).alias("dataset"),
                "c.column_name",
                "c.data_type",
                "filas",
                F.lit(len(df.columns)).alias("columnas"),
            )
        )
    return union_all(parts)


def describe_text(df: DataFrame) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    The most frequent value with the smallest text wins ties. Columns are
    unpivoted so one shuffle on (column, value) serves all of them, with equal
    values already counted on the map side.
    """
    freq = (
        _cells(df)
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    present = F.col("value").isNotNull()
    rank = F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))
    return freq.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("count"),
        count_true(present).alias("unique"),
        F.min_by("value", F.when(present, rank)).alias("top"),
        F.max(F.when(present, F.col("n"))).alias("freq"),
    )


def volumes(datasets: Datasets) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("filas")).select(
                F.lit(name).alias("dataset"),
                "filas",
                F.lit(len(df.columns)).alias("columnas"),
            )
            for name, df in datasets.items()
        ]
    ).orderBy(F.desc("filas"), "dataset")


def null_cells(datasets: Datasets) -> DataFrame:
    """NULLs per column, and the dataset's total on every row."""
    parts = []
    for name, df in datasets.items():
        counts = df.agg(*(count_null(c).alias(c) for c in df.columns))
        total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
        parts.append(
            counts.withColumn("total_nulls", total)
            .unpivot(["total_nulls"], list(df.columns), "column_name", "nulls")
            .select(F.lit(name).alias("dataset"), "column_name", "nulls", "total_nulls")
        )
    return union_all(parts)


def routes_per_type(routes: DataFrame) -> DataFrame:
    return (
        routes.where("route_type IS NOT NULL")
        .groupBy("route_type")
        .agg(F.count(F.lit(1)).alias("num_rutas"))
        .orderBy(F.desc("num_rutas"), "route_type")
    )


def first_routes(routes: DataFrame, n: int = 20) -> DataFrame:
    return (
        routes.orderBy(F.asc_nulls_last("route_short_name"), "route_id")
        .limit(n)
        .select("route_short_name", "route_long_name", "route_type")
    )


def stops_without_coordinates(stops: DataFrame) -> DataFrame:
    def absent(name: str) -> Column:
        value = F.col(name).cast("string")
        return value.isNull() | (value == "")

    return stops.agg(
        count_true(absent("stop_lat") | absent("stop_lon")).alias("paradas_sin_coordenadas")
    )


def repeated_stop_ids(stops: DataFrame) -> DataFrame:
    return surplus_rows(stops, ["stop_id"]).select(
        F.col("n").alias("stop_id_duplicados")
    )


def reference_gaps(datasets: Datasets) -> DataFrame:
    """Per reference: distinct child ids and child rows without a parent.

    Unlike the quality rules, NULL matches NULL here. Child rows are counted per
    id before the join, so a hot id is a single row by then.
    """
    parts = []
    for child, key, parent in schemas.REFERENCES:
        gaps = orphan_rows(datasets[child], datasets[parent], key)
        parts.append(
            gaps.agg(
                F.count(F.lit(1)).alias("ids_sin_correspondencia"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("filas_sin_correspondencia"),
            ).select(
                F.lit(f"{child}.{key}").alias("referencia"),
                "ids_sin_correspondencia",
                "filas_sin_correspondencia",
            )
        )
    return union_all(parts)


def trips_per_route(trips: DataFrame) -> DataFrame:
    return (
        trips.where("route_id IS NOT NULL")
        .groupBy("route_id")
        .agg(F.count(F.lit(1)).alias("num_trips"))
    )


def trips_per_route_stats(trips: DataFrame) -> DataFrame:
    return trips_per_route(trips).agg(
        F.round(F.avg("num_trips"), 2).alias("media"),
        F.max("num_trips").alias("maximo"),
        F.min("num_trips").alias("minimo"),
    )


def coordinate_range(stops: DataFrame) -> DataFrame:
    lat = F.col("stop_lat").try_cast("double")
    lon = F.col("stop_lon").try_cast("double")
    return stops.agg(
        count_null("stop_lat").alias("sin_latitud"),
        count_null("stop_lon").alias("sin_longitud"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
    )


def network_stops(
    datasets: Datasets, route_type: int, color_of, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Stops of one transport mode with the lines that call there.

    Routes are filtered before the joins, and (stop, route) pairs made distinct
    before names are joined on. Per stop, equal line names are counted first, so
    the lists are assembled from one row per line name. ``keys`` are extra join
    columns, e.g. ``snapshot_date`` over a history.
    """
    routes = (
        datasets["routes"]
        .where(F.col("route_type") == route_type)
        .groupBy("route_id", *keys)
        .agg(F.min("route_short_name").alias("route_short_name"))
    )
    trips = (
        datasets["trips"]
        .select("trip_id", "route_id", *keys)
        .join(routes.select("route_id", *keys), ["route_id", *keys], "left_semi")
    )
    stops = datasets["stops"].select(
        "stop_id",
        "stop_name",
        F.col("stop_lat").try_cast("double").alias("stop_lat"),
        F.col("stop_lon").try_cast("double").alias("stop_lon"),
        *keys,
    )
    place = ["stop_id", "stop_name", "stop_lat", "stop_lon", *keys]
    calls = (
        datasets["stop_times"]
        .select("stop_id", "trip_id", *keys)
        .join(trips, ["trip_id", *keys])
        .select("stop_id", "route_id", *keys)
        .distinct()
    )
    lines = (
        calls.join(routes, ["route_id", *keys])
        .groupBy("stop_id", "route_short_name", *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(stops.dropna(subset=place), ["stop_id", *keys])
        .withColumn("color", color_of(F.col("route_short_name")))
    )
    # One colour entry per route, sorted; expanded from the counts at the end.
    repeated = F.flatten(
        F.transform(
            F.sort_array(F.collect_list(F.struct("color", "n"))),
            lambda e: F.array_repeat(e["color"], e["n"].cast("int")),
        )
    )
    grouped = lines.groupBy(*place).agg(
        F.count("route_short_name").alias("route_count"),
        F.array_join(F.sort_array(F.collect_list("route_short_name")), ", ").alias("routes"),
        repeated.alias("colors"),
        F.min("color").alias("_color"),
    )
    return grouped.withColumn(
        "display_color",
        F.when(F.col("route_count") == 1, F.col("_color")).otherwise(
            schemas.SHARED_STOP_COLOR
        ),
    ).drop("_color")


def metro_stops(datasets: Datasets, keys: tuple[str, ...] = ()) -> DataFrame:
    return network_stops(datasets, 1, metro_color, keys)


def bus_stops(datasets: Datasets, keys: tuple[str, ...] = ()) -> DataFrame:
    return network_stops(datasets, 3, bus_color, keys)


def network_totals(stops: DataFrame) -> DataFrame:
    return stops.agg(
        F.count(F.lit(1)).alias("paradas"),
        count_true(F.col("route_count") == 1).alias("una_linea"),
        count_true(F.col("route_count") > 1).alias("varias_lineas"),
    )


def route_type_distribution(routes: DataFrame) -> DataFrame:
    counts = (
        routes.where("route_type IS NOT NULL")
        .groupBy("route_type")
        .agg(F.count(F.lit(1)).alias("num_rutas"))
    )
    return counts.orderBy(F.col("route_type").cast("string")).select(
        route_type_name(F.col("route_type")).alias("tipo"), "num_rutas"
    )


def top_routes(datasets: Datasets, n: int = 20) -> DataFrame:
    """Busiest routes with names; the label falls back to the id."""
    names = datasets["routes"].select("route_id", "route_short_name", "route_long_name")
    return (
        trips_per_route(datasets["trips"])
        .join(names, "route_id", "left")
        .orderBy(F.desc("num_trips"), "route_id")
        .limit(n)
        .select(
            "route_short_name",
            "route_long_name",
            "num_trips",
            F.coalesce("route_short_name", "route_id").alias("etiqueta"),
        )
    )


def trips_histogram(trips: DataFrame, bins: int = 20) -> DataFrame:
    """Routes per equal-width bin of their trip count; the last bin is closed.

    Routes are first folded to (trip count, routes) pairs. Equal counts widen the
    range by one half on both sides, as plotting does.
    """
    spread = (
        trips_per_route(trips)
        .groupBy("num_trips")
        .agg(F.count(F.lit(1)).alias("routes"))
    )
    edges = spread.agg(
        F.struct(
            F.min("num_trips").cast("double").alias("lo"),
            F.max("num_trips").cast("double").alias("hi"),
        )
    ).scalar()
    wide = spread.withColumn("_e", edges)
    flat = F.col("_e.lo") == F.col("_e.hi")
    lo = F.when(flat, F.col("_e.lo") - 0.5).otherwise(F.col("_e.lo"))
    hi = F.when(flat, F.col("_e.hi") + 0.5).otherwise(F.col("_e.hi"))
    step = (F.col("num_trips") - lo) * bins / (hi - lo)
    return (
        wide.select(
            F.least(F.lit(bins), F.floor(step).cast("int") + 1).alias("bin"), "routes"
        )
        .groupBy("bin")
        .agg(F.sum("routes").alias("num_rutas"))
        .orderBy("bin")
    )


def compare_volumes(raw: Datasets, processed: Datasets) -> DataFrame:
    """Rows before and after cleaning."""

    def counted(datasets: Datasets, column: str) -> DataFrame:
        return union_all(
            [
                df.agg(F.count(F.lit(1)).alias(column)).withColumn("dataset", F.lit(name))
                for name, df in datasets.items()
            ]
        )

    return (
        counted(raw, "registros_raw")
        .join(counted(processed, "registros_processed"), "dataset")
        .select(
            "dataset",
            "registros_raw",
            "registros_processed",
            (F.col("registros_raw") - F.col("registros_processed")).alias(
                "registros_eliminados"
            ),
        )
    )


def route_trip_counts(datasets: Datasets) -> DataFrame:
    """Every distinct route row with its number of distinct trip rows, 0 when none."""
    trips = datasets["trips"].dropDuplicates()
    counts = trips.groupBy("route_id").agg(F.count(F.lit(1)).alias("trip_count"))
    return (
        datasets["routes"]
        .dropDuplicates()
        .join(counts, "route_id", "left")
        .withColumn("trip_count", F.coalesce("trip_count", F.lit(0)).cast("int"))
    )


def top_route_trip_counts(datasets: Datasets, n: int = 10) -> DataFrame:
    return (
        route_trip_counts(datasets)
        .orderBy(F.desc("trip_count"), "route_id")
        .limit(n)
        .select("route_short_name", "trip_count")
    )
