"""Cleaning rules over the dirty feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import add
from tramline import schemas
from tramline.functions.aggregates import union_all
from tramline.operators import clean, profile


def strip(x: str) -> str:
    return f"nullif(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '')"


def fields(dataset: str) -> list[str]:
    return schemas.feed_schema(dataset).fieldNames()


def normalised(dataset: str, origin: str = "d") -> str:
    """SELECT of the stripped texts, numbers parsed as the text rules do."""
    out = []
    for name in fields(dataset):
        text = strip(name)
        if name in ("stop_lat", "stop_lon"):
            text = f"TRY_CAST({text} AS DOUBLE)"
        elif name == "stop_sequence":
            text = f"TRY_CAST({text} AS INT)"
        out.append(f"{text} AS {name}")
    extra = ", ord" if origin == "o" else ""
    return f"SELECT {', '.join(out)}{extra} FROM {origin}_{dataset}"


FIRST_STOPS = (
    f"SELECT {', '.join(fields('stops'))} FROM ({normalised('stops', 'o')}) "
    "QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY ord, stop_code) = 1"
)


def _dirty(dataset, *steps, order=False):
    def build(spark, sf):
        df = views.dirty(spark, sf, dataset, order)
        for step in steps:
            df = step(df)
        return df

    return build


def _pad_names(df):
    return df.toDF(*(f" {c}\t" for c in df.columns))


def _first_stop(df):
    kept = clean.keep_first(df, ["stop_id"], F.struct("ord", "stop_code"))
    return kept.drop("ord")


add(
    "c01_trim_column_names",
    _dirty("trips", _pad_names, clean.trim_column_names),
    "SELECT * FROM d_trips",
)
add(
    "c02_normalise_text",
    _dirty("routes", clean.normalise_text),
    normalised("routes"),
)
add(
    "c03_parse_coordinates",
    _dirty("stops", clean.parse_coordinates),
    "SELECT * REPLACE (TRY_CAST(stop_lat AS DOUBLE) AS stop_lat, "
    "TRY_CAST(stop_lon AS DOUBLE) AS stop_lon) FROM d_stops",
)
add(
    "c04_parse_sequence",
    _dirty("stop_times", clean.parse_sequence),
    "SELECT * REPLACE (TRY_CAST(stop_sequence AS INT) AS stop_sequence) FROM d_stop_times",
)
add(
    "c05_drop_duplicate_rows",
    _dirty("trips", clean.normalise_text, clean.drop_duplicate_rows),
    normalised("trips").replace("SELECT", "SELECT DISTINCT", 1),
)
add(
    "c06_keep_first_stop",
    _dirty(
        "stops", clean.normalise_text, clean.parse_coordinates, _first_stop, order=True
    ),
    FIRST_STOPS,
)
add(
    "c07_drop_missing_ids",
    _dirty(
        "stop_times",
        clean.normalise_text,
        clean.parse_sequence,
        lambda df: clean.drop_missing(df, schemas.ROW_IDENTIFIERS["stop_times"]),
    ),
    f"SELECT * FROM ({normalised('stop_times')}) "
    "WHERE trip_id IS NOT NULL AND stop_id IS NOT NULL",
)
add(
    "c08_drop_missing_coordinates",
    _dirty(
        "stops",
        clean.normalise_text,
        clean.parse_coordinates,
        lambda df: clean.drop_missing(df, ["stop_lat", "stop_lon"]),
    ),
    f"SELECT * FROM ({normalised('stops')}) "
    "WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL",
)


def date(name: str) -> str:
    return f"CAST(try_strptime({name}, '%Y%m%d') AS DATE)"


# Column replacements and row filter of the typed rules.
TYPED = {
    "routes": (
        {"route_short_name": "trim(route_short_name)", "route_long_name": "trim(route_long_name)"},
        None,
    ),
    "trips": ({"trip_headsign": "trim(trip_headsign)"}, None),
    "stops": (
        {"stop_name": "trim(stop_name)"},
        "stop_id IS NOT NULL AND stop_lat IS NOT NULL AND stop_lon IS NOT NULL",
    ),
    "stop_times": (
        {"arrival_time": "trim(arrival_time)", "departure_time": "trim(departure_time)"},
        "trip_id IS NOT NULL AND stop_id IS NOT NULL",
    ),
    "calendar": ({"start_date": date("start_date"), "end_date": date("end_date")}, None),
    "calendar_dates": ({"date": date("date")}, None),
    "agency": ({}, None),
}


def typed_sql(dataset: str) -> str:
    columns, keep = TYPED[dataset]
    picked = ", ".join(f"{columns[c]} AS {c}" if c in columns else c for c in fields(dataset))
    where = f" WHERE {keep}" if keep else ""
    return f"SELECT {picked} FROM (SELECT DISTINCT * FROM t_{dataset}){where}"


for number, dataset in enumerate(
    ("routes", "trips", "stops", "stop_times", "calendar", "calendar_dates"), start=9
):
    add(
        f"c{number:02d}_clean_{dataset}",
        lambda spark, sf, d=dataset: clean.CLEANERS[d](views.typed_feed(spark, sf, [d])[d]),
        typed_sql(dataset),
    )


def content(frames):
    """All rows of several datasets as texts, told apart by the dataset."""
    return union_all(
        [
            df.select(
                F.lit(name).alias("dataset"),
                F.concat_ws(
                    "|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns)
                ).alias("row"),
            )
            for name, df in frames.items()
        ]
    )


def content_sql(selects: dict[str, str], columns=None) -> str:
    def row(name):
        own = columns[name] if columns else fields(name)
        return ", ".join(f"coalesce(CAST({c} AS STRING), '-')" for c in own)

    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, concat_ws('|', {row(name)}) AS row FROM ({sql})"
        for name, sql in selects.items()
    )


def _counts(selects: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS rows FROM ({sql})"
        for name, sql in selects.items()
    )


def text_rules_sql(dataset: str) -> str:
    if dataset == "stops":
        return (
            f"SELECT * FROM ({FIRST_STOPS}) WHERE stop_id IS NOT NULL "
            "AND stop_lat IS NOT NULL AND stop_lon IS NOT NULL"
        )
    keep = " AND ".join(
        f"{c} IS NOT NULL" for c in schemas.ROW_IDENTIFIERS.get(dataset, ())
    )
    where = f" WHERE {keep}" if keep else ""
    return f"SELECT DISTINCT * FROM ({normalised(dataset)}){where}"


def _text_feed(spark, sf):
    """The dirty feed with a feed position on the stops, as a reader attaches it."""
    feed = views.dirty_feed(spark, sf, schemas.TEXT_DATASETS)
    stops = views.dirty(spark, sf, "stops", order=True)
    feed["stops"] = stops.withColumn(
        clean.SOURCE_ROW, F.struct("ord", "stop_code")
    ).drop("ord")
    return feed


add(
    "c15_clean_text_feed",
    lambda spark, sf: content(clean.clean_text_feed(_text_feed(spark, sf))),
    content_sql({d: text_rules_sql(d) for d in schemas.TEXT_DATASETS}),
)
add(
    "c15_clean_text_stops",
    lambda spark, sf: clean.clean_text_feed(_text_feed(spark, sf))["stops"],
    text_rules_sql("stops"),
)
add(
    "c15_clean_typed_feed",
    lambda spark, sf: content(clean.clean_feed(views.typed_feed(spark, sf))),
    content_sql({d: typed_sql(d) for d in schemas.DATASETS}),
)
add(
    "p19_compare_volumes",
    lambda spark, sf: profile.compare_volumes(
        _text_feed(spark, sf), clean.clean_text_feed(_text_feed(spark, sf))
    ),
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, a AS registros_raw, b AS registros_processed, "
        f"a - b AS registros_eliminados FROM (SELECT (SELECT count(*) FROM d_{d}) AS a, "
        f"(SELECT count(*) FROM ({text_rules_sql(d)})) AS b)"
        for d in schemas.TEXT_DATASETS
    ),
)
