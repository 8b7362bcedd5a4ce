"""Cleaning of feed datasets.

Two rule sets exist side by side. ``clean_text_feed`` works on all-text frames
and normalises before removing duplicates. ``clean_feed`` works on typed frames:
it removes duplicates first, trims descriptive texts by spaces only and leaves
ids as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions.text import clean_text
from tramline.sources.feed import SOURCE_ROW

Datasets = dict[str, DataFrame]


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def normalise_text(df: DataFrame) -> DataFrame:
    """Strip every text column; blank becomes NULL."""
    return df.select(
        *(
            clean_text(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def to_number(df: DataFrame, columns: Sequence[str], data_type: str) -> DataFrame:
    """Parse text columns as numbers; what does not parse becomes NULL, the row stays."""
    return df.withColumns({c: F.col(c).try_cast(data_type) for c in columns})


def parse_coordinates(stops: DataFrame) -> DataFrame:
    return to_number(stops, ["stop_lat", "stop_lon"], "double")


def parse_sequence(stop_times: DataFrame) -> DataFrame:
    return to_number(stop_times, ["stop_sequence"], "int")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of each row; with a feed position, the copy that came first."""
    if SOURCE_ROW not in df.columns:
        return df.dropDuplicates()
    values = [c for c in df.columns if c != SOURCE_ROW]
    return df.groupBy(*values).agg(F.min(SOURCE_ROW).alias(SOURCE_ROW))


def keep_first(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """First row of each key by ``order``, as an aggregate.

    ``min_by`` combines on the map side, so copies of one key are reduced where
    they are read; a ranking window would sort them all in one task. NULL is a
    key like any other.
    """
    order = F.col(order) if isinstance(order, str) else order
    values = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*values), order).alias("_first")
    )
    return first.select(
        *(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns)
    )


def _position(df: DataFrame, key: str) -> Column:
    """Feed position if it was read along, else the smallest row wins."""
    if SOURCE_ROW in df.columns:
        return F.col(SOURCE_ROW)
    return F.struct(*(c for c in df.columns if c != key))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def clean_text_feed(datasets: Datasets) -> Datasets:
    """The whole text rule set: names, texts, numbers, copies, ids, coordinates."""
    out = {}
    for name, df in datasets.items():
        df = normalise_text(trim_column_names(df))
        if name == "stops":
            df = parse_coordinates(df)
        elif name == "stop_times":
            df = parse_sequence(df)
        if name == "stops":
            # Keeping the first row per stop_id also removes full copies.
            df = keep_first(df, ["stop_id"], _position(df, "stop_id"))
        else:
            df = drop_duplicate_rows(df)
        if name in schemas.ROW_IDENTIFIERS:
            df = drop_missing(df, schemas.ROW_IDENTIFIERS[name])
        if name == "stops":
            df = drop_missing(df, ["stop_lat", "stop_lon"])
        out[name] = df.drop(SOURCE_ROW)
    return out


def _with(df: DataFrame, *near: str, **columns: Column) -> DataFrame:
    """One copy of each row; rows that agree in the columns ``near`` (all by default) come to one task.

    Few rows of a feed are copies, so combining them where they are read would
    hold, and spill, nearly all rows there: they are dealt out first.
    """
    return df.repartition(*(near or df.columns)).dropDuplicates().withColumns(columns)


def _texts(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("string") for n in names}


def _trimmed(*names: str) -> dict[str, Column]:
    return {n: F.trim(F.col(n)) for n in names}


def _integers(*names: str) -> dict[str, Column]:
    return {n: F.col(n).try_cast("int") for n in names}


def _dates(*names: str) -> dict[str, Column]:
    return {n: F.expr(f"try_to_date(CAST({n} AS STRING), 'yyyyMMdd')") for n in names}


def clean_routes(df: DataFrame) -> DataFrame:
    return _with(
        df,
        **_texts("route_id"),
        **_trimmed("route_short_name", "route_long_name"),
        **_integers("route_type"),
    )


def clean_trips(df: DataFrame) -> DataFrame:
    return _with(
        df,
        **_texts("route_id", "service_id", "trip_id"),
        **_trimmed("trip_headsign"),
        **_integers("direction_id"),
    )


def clean_stops(df: DataFrame) -> DataFrame:
    cleaned = _with(
        df,
        **_texts("stop_id", "stop_code"),
        **_trimmed("stop_name"),
        **{c: F.col(c).try_cast("double") for c in ("stop_lat", "stop_lon")},
    )
    return drop_missing(cleaned, ["stop_id", "stop_lat", "stop_lon"])


def clean_stop_times(df: DataFrame) -> DataFrame:
    # Calls stay with their trip, so the trips of a stored part are few.
    return _with(
        drop_missing(df, ["trip_id", "stop_id"]),
        "trip_id",
        **_texts("trip_id", "stop_id"),
        **_integers("stop_sequence"),
        **_trimmed("arrival_time", "departure_time"),
    )


def clean_calendar(df: DataFrame) -> DataFrame:
    return _with(df, **_texts("service_id"), **_dates("start_date", "end_date"))


def clean_calendar_dates(df: DataFrame) -> DataFrame:
    return _with(
        df, **_texts("service_id"), **_dates("date"), **_integers("exception_type")
    )


CLEANERS = {
    "agency": DataFrame.dropDuplicates,
    "routes": clean_routes,
    "trips": clean_trips,
    "stops": clean_stops,
    "stop_times": clean_stop_times,
    "calendar": clean_calendar,
    "calendar_dates": clean_calendar_dates,
}


def clean_feed(datasets: Datasets) -> Datasets:
    """The typed rule set over a whole snapshot."""
    return {name: CLEANERS[name](df) for name, df in datasets.items()}
