"""Dataset schemas, contracts and fixed label tables."""

from __future__ import annotations

from pyspark.sql import types as T

WEEKDAYS = (
    "monday",
    "tuesday",
    "wednesday",
    "thursday",
    "friday",
    "saturday",
    "sunday",
)

STRING, INT, BIGINT = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, TIMESTAMP = T.DoubleType(), T.TimestampType()

# Columns of the raw feed files. Dates stay yyyyMMdd text and clock
# times stay text (hours run past 24), so nothing here is ever inferred.
FEED = {
    "agency": {
        "agency_name": STRING,
        "agency_url": STRING,
        "agency_timezone": STRING,
        "agency_lang": STRING,
        "agency_phone": STRING,
    },
    "routes": {
        "route_id": STRING,
        "route_short_name": STRING,
        "route_long_name": STRING,
        "route_type": INT,
        "route_url": STRING,
        "route_color": STRING,
        "route_text_color": STRING,
    },
    "trips": {
        "route_id": STRING,
        "service_id": STRING,
        "trip_id": STRING,
        "trip_headsign": STRING,
        "direction_id": INT,
        "shape_id": STRING,
        "wheelchair_accessible": INT,
    },
    "stops": {
        "stop_id": STRING,
        "stop_code": STRING,
        "stop_name": STRING,
        "stop_lat": DOUBLE,
        "stop_lon": DOUBLE,
        "stop_url": STRING,
        "location_type": INT,
        "parent_station": STRING,
        "wheelchair_boarding": INT,
    },
    "stop_times": {
        "trip_id": STRING,
        "arrival_time": STRING,
        "departure_time": STRING,
        "stop_id": STRING,
        "stop_sequence": INT,
    },
    "calendar": {
        "service_id": STRING,
        **{day: INT for day in WEEKDAYS},
        "start_date": STRING,
        "end_date": STRING,
    },
    "calendar_dates": {"service_id": STRING, "date": STRING, "exception_type": INT},
}
DATASETS = tuple(FEED)
OPTIONAL_DATASETS = ("calendar_dates",)
TEXT_DATASETS = tuple(d for d in DATASETS if d not in OPTIONAL_DATASETS)


def struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def feed_schema(dataset: str) -> T.StructType:
    return struct(FEED[dataset])


# Raw contract: every feed column of the six mandatory files must be present.
RAW_REQUIRED = {d: feed_schema(d).fieldNames() for d in TEXT_DATASETS}

# Identifier columns that must not be NULL, before and after processing.
RAW_IDENTIFIERS = {
    "routes": ["route_id"],
    "trips": ["trip_id", "route_id"],
    "stops": ["stop_id"],
    "stop_times": ["trip_id", "stop_id"],
    "calendar": ["service_id"],
}
PROCESSED_IDENTIFIERS = {
    "agency": ["agency_name"],
    "routes": ["route_id"],
    "stops": ["stop_id"],
    "calendar": ["service_id"],
    "calendar_dates": ["service_id"],
    "trips": ["trip_id", "route_id", "service_id"],
    "stop_times": ["trip_id", "stop_id"],
}
# Business key per processed dataset; also the minimal column contract together
# with the identifiers.
BUSINESS_KEYS = {
    "agency": ["agency_name"],
    "routes": ["route_id"],
    "stops": ["stop_id"],
    "calendar": ["service_id"],
    "calendar_dates": ["service_id", "date"],
    "trips": ["trip_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence"],
}
PROCESSED_REQUIRED = {
    d: list(dict.fromkeys(PROCESSED_IDENTIFIERS[d] + BUSINESS_KEYS[d]))
    for d in BUSINESS_KEYS
}
# Identifiers whose absence drops the row during cleaning.
ROW_IDENTIFIERS = {
    "routes": ["route_id"],
    "trips": ["trip_id"],
    "stops": ["stop_id"],
    "stop_times": ["trip_id", "stop_id"],
    "calendar": ["service_id"],
}
# Child dataset, child column, parent dataset
REFERENCES = (
    ("trips", "route_id", "routes"),
    ("stop_times", "trip_id", "trips"),
    ("stop_times", "stop_id", "stops"),
)

# Warehouse tables: NOT NULL columns, VARCHAR lengths, unique keys, foreign keys.
# Fixed values of the relational and star schemas.
NOT_NULL = {
    "agency": ["agency_name", "snapshot_date"],
    "routes": ["route_id", "snapshot_date"],
    "stops": ["stop_id", "snapshot_date"],
    "calendar": ["service_id", "snapshot_date"],
    "calendar_dates": ["service_id", "date", "exception_type", "snapshot_date"],
    "trips": ["trip_id", "route_id", "service_id", "snapshot_date"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "snapshot_date"],
    "realtime_bus_arrivals": ["event_timestamp"],
    "dim_route": ["route_key", "route_id", "snapshot_date"],
    "dim_stop": ["stop_key", "stop_id", "snapshot_date"],
    "dim_service": ["service_key", "service_id", "snapshot_date"],
    "fact_trip": ["trip_key", "trip_id", "route_key", "service_key", "snapshot_date"],
    "fact_stop_time": [
        "stop_time_key",
        "trip_key",
        "stop_key",
        "stop_sequence",
        "snapshot_date",
    ],
}
MAX_LENGTH = {
    "agency": {
        "agency_name": 255,
        "agency_url": 500,
        "agency_timezone": 100,
        "agency_lang": 10,
        "agency_phone": 50,
    },
    "routes": {
        "route_id": 100,
        "route_short_name": 100,
        "route_long_name": 255,
        "route_url": 500,
        "route_color": 20,
        "route_text_color": 20,
    },
    "stops": {
        "stop_id": 100,
        "stop_code": 100,
        "stop_name": 255,
        "stop_url": 500,
        "parent_station": 100,
    },
    "calendar": {"service_id": 100},
    "calendar_dates": {"service_id": 100},
    "trips": {
        "trip_id": 100,
        "route_id": 100,
        "service_id": 100,
        "trip_headsign": 255,
        "shape_id": 100,
    },
    "stop_times": {
        "trip_id": 100,
        "stop_id": 100,
        "arrival_time": 20,
        "departure_time": 20,
    },
    "realtime_bus_arrivals": {
        "destination": 255,
        "line": 20,
        "route_id": 20,
        "stop_id": 20,
        "arrival_text": 100,
    },
}
UNIQUE_KEYS = {
    **{d: BUSINESS_KEYS[d] + ["snapshot_date"] for d in BUSINESS_KEYS},
    "dim_route": ["route_id", "snapshot_date"],
    "dim_stop": ["stop_id", "snapshot_date"],
    "dim_service": ["service_id", "snapshot_date"],
    "fact_trip": ["trip_id", "snapshot_date"],
}
# child table, child columns, parent table
FOREIGN_KEYS = (
    ("trips", ["route_id", "snapshot_date"], "routes"),
    ("stop_times", ["trip_id", "snapshot_date"], "trips"),
    ("stop_times", ["stop_id", "snapshot_date"], "stops"),
)
STAR_FOREIGN_KEYS = (
    ("fact_trip", ["route_key"], "dim_route"),
    ("fact_trip", ["service_key"], "dim_service"),
    ("fact_stop_time", ["trip_key"], "fact_trip"),
    ("fact_stop_time", ["stop_key"], "dim_stop"),
)

# Fields of arrival messages, and the flat table they end in.
ARRIVAL_MESSAGE = struct(
    {
        "timestamp": BIGINT,
        "destination": STRING,
        "line": STRING,
        "route_id": STRING,
        "stop": STRING,
        "time_in_minutes": BIGINT,
        "time_in_seconds": BIGINT,
        "text_ca": STRING,
    }
)
ARRIVALS = struct(
    {
        "event_timestamp": TIMESTAMP,
        "destination": STRING,
        "line": STRING,
        "route_id": STRING,
        "stop_id": STRING,
        "arrival_minutes": BIGINT,
        "arrival_seconds": BIGINT,
        "arrival_text": STRING,
    }
)

# Printed labels and map colours.
TRANSPORT = {0: "Tranvía", 1: "Metro", 3: "Autobús", 7: "Funicular"}
TRANSPORT_OTHER = "Otro"
ROUTE_TYPE_NAMES = {
    "0": "Tranvía",
    "1": "Metro",
    "2": "Ferrocarril",
    "3": "Bus",
    "4": "Ferry",
    "5": "Teleférico",
    "6": "Telecabina",
    "7": "Funicular",
}
DAY_NAMES = {
    "monday": "Lunes",
    "tuesday": "Martes",
    "wednesday": "Miércoles",
    "thursday": "Jueves",
    "friday": "Viernes",
    "saturday": "Sábado",
    "sunday": "Domingo",
}
METRO_COLORS = {
    "L1": "#E23A3C",
    "L2": "#9E469C",
    "L3": "#52BA54",
    "L4": "#FEBE14",
    "L5": "#327ACC",
    "L6": "#867EC4",
    "L7": "#AE621C",
    "L8": "#E27AB4",
    "L9N": "#F6862C",
    "L9S": "#F6862C",
    "L10N": "#02AEEC",
    "L10S": "#02AEEC",
    "L11": "#AAD264",
    "L12": "#B6B3E1",
}
METRO_OTHER = "#808080"
BUS_PREFIX_COLORS = {"V": "#009966", "H": "#0072BB", "D": "#952B89"}
BUS_OTHER = "#E23A3C"
SHARED_STOP_COLOR = "#666666"
