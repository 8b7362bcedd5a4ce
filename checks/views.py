"""Transit-shaped views of the driver tables.

Each view is a list of select expressions that both Spark and DuckDB accept. The
Spark side builds DataFrames from them, the oracle side common table
expressions, so both engines see the same input.

Three families:

* ``g_*``  clean tables, one yearly snapshot per row (the warehouse's history)
* ``d_*``  a dirty all-text feed: padding, blanks, bad numbers, copies, NULL ids
* messages and stored arrivals made from ``events``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import schemas

Tables = dict[str, DataFrame]


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_text(x: str) -> str:
    return f"CAST({x} AS STRING)"


# --- clean history --------------------------------------------------------

SNAPSHOT = "make_date(CAST(year(o_orderdate) AS INT), 1, 1)"
SHORT_NAME = (
    "concat(substr('VHDLX', CAST(c_custkey % 5 + 1 AS INT), 1), CAST(c_custkey % 40 AS STRING))"
)
ROUTE_TYPE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 "
    "WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 7 ELSE 4 END"
)
LAT = "41 + (p_partkey % 500) / 1000"
LON = "2 + (p_partkey % 400) / 1000"
DIRECTION = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END"
CLOCK = "concat(lpad(CAST(5 + 3 * l_linenumber AS STRING), 2, '0'), ':%s:00')"


def flag(day: int, key: str = "n_nationkey") -> str:
    return f"CASE WHEN {key} % {day + 2} = 0 THEN 1 ELSE 0 END"


# view -> (driver table, row filter or None, expressions); snapshot_date is added
PER_SNAPSHOT = {
    "g_agency": (
        "region",
        None,
        [
            "r_name AS agency_name",
            "concat('https://example.org/', CAST(r_regionkey AS STRING)) AS agency_url",
            "'Europe/Madrid' AS agency_timezone",
            "'ca' AS agency_lang",
            "concat('00', CAST(r_regionkey AS STRING)) AS agency_phone",
        ],
    ),
    "g_routes": (
        "customer",
        None,
        [
            f"{as_text('c_custkey')} AS route_id",
            f"{SHORT_NAME} AS route_short_name",
            "c_name AS route_long_name",
            f"{ROUTE_TYPE} AS route_type",
            f"concat('https://example.org/r/', {as_text('c_custkey')}) AS route_url",
            f"lpad({as_text('c_custkey % 1000')}, 6, '0') AS route_color",
            "'FFFFFF' AS route_text_color",
        ],
    ),
    "g_stops": (
        "part",
        None,
        [
            f"{as_text('p_partkey')} AS stop_id",
            f"lpad({as_text('p_partkey')}, 6, '0') AS stop_code",
            "p_name AS stop_name",
            f"{LAT} AS stop_lat",
            f"{LON} AS stop_lon",
            "CAST(NULL AS STRING) AS stop_url",
            "CAST(p_size % 3 AS INT) AS location_type",
            "CAST(NULL AS STRING) AS parent_station",
            "CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(p_size % 2 AS INT) END "
            "AS wheelchair_boarding",
        ],
    ),
    "g_calendar": (
        "nation",
        None,
        [
            f"{as_text('n_nationkey')} AS service_id",
            *(f"{flag(i)} AS {day}" for i, day in enumerate(schemas.WEEKDAYS)),
            "DATE '2026-01-01' AS start_date",
            "DATE '2026-12-31' AS end_date",
        ],
    ),
    "g_calendar_dates": (
        "nation",
        None,
        [
            f"{as_text('n_nationkey')} AS service_id",
            "DATE '2026-09-14' AS date",
            "CAST(1 + n_nationkey % 2 AS INT) AS exception_type",
        ],
    ),
}
# Rows on top of the driver's: services known only by exception dates, with trips or without.
EXTRA = {
    "g_calendar_dates": (
        "region",
        None,
        [
            "CASE r_regionkey WHEN 0 THEN 'dated' ELSE concat('idle ', CAST(r_regionkey AS STRING)) END "
            "AS service_id",
            "DATE '2026-10-12' AS date",
            "CAST(1 AS INT) AS exception_type",
        ],
    ),
}
TRIPS = [
    f"{as_text('o_orderkey')} AS trip_id",
    f"{as_text('o_custkey')} AS route_id",
    f"{as_text('o_orderkey % 25')} AS service_id",
    "o_orderpriority AS trip_headsign",
    f"{DIRECTION} AS direction_id",
    f"concat('S', {as_text('o_custkey % 50')}) AS shape_id",
    "CAST(o_orderkey % 3 AS INT) AS wheelchair_accessible",
    f"{SNAPSHOT} AS snapshot_date",
]
# Trips on top of the driver's: of an exceptions-only service, of a service and of a route nobody knows.
EXTRA_TRIPS_OF = "o_orderkey % 50 = 0"
EXTRA_TRIPS = [
    f"concat('x', {as_text('o_orderkey')}) AS trip_id",
    f"CASE WHEN o_orderkey % 150 = 100 THEN concat('gone ', {as_text('o_custkey % 7')}) "
    f"ELSE {as_text('o_custkey')} END AS route_id",
    f"CASE o_orderkey % 150 WHEN 0 THEN 'orphan' WHEN 50 THEN 'dated' "
    f"ELSE {as_text('o_orderkey % 25')} END AS service_id",
    *TRIPS[3:],
]
STOP_TIMES = [
    f"{as_text('l_orderkey')} AS trip_id",
    f"{as_text('l_partkey')} AS stop_id",
    f"{CLOCK % '00'} AS arrival_time",
    f"{CLOCK % '01'} AS departure_time",
    "CAST(l_linenumber AS INT) AS stop_sequence",
    f"{SNAPSHOT} AS snapshot_date",
]
ARRIVALS = [
    "ts AS event_timestamp",
    "concat('to ', event_type) AS destination",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS line",
    f"{as_text('user_id')} AS route_id",
    f"{as_text('user_id % 50')} AS stop_id",
    "CAST(floor(value * 10 / 60) AS BIGINT) AS arrival_minutes",
    "CASE WHEN event_id % 89 = 0 THEN -1 ELSE CAST(floor(value * 10) AS BIGINT) END "
    "AS arrival_seconds",
    "concat(CAST(CAST(floor(value * 10 / 60) AS INT) AS STRING), ' min') AS arrival_text",
]


class Lazy(dict):
    """Tables opened when a plan first asks for them."""

    def __init__(self, names, opened):
        super().__init__()
        self._names, self._opened = tuple(names), opened

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._opened(name)
        return self[name]

    def all(self) -> Tables:
        return {name: self[name] for name in self._names}


def _per_snapshot(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    out = None
    for parts in (PER_SNAPSHOT, EXTRA):
        if f"g_{name}" in parts:
            table, keep, expressions = parts[f"g_{name}"]
            df = source(spark, sf_dir, table)
            df = (df.where(keep) if keep else df).selectExpr(*expressions)
            out = df if out is None else out.unionByName(df)
    return out


def _trips(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*TRIPS).unionByName(
        orders.where(EXTRA_TRIPS_OF).selectExpr(*EXTRA_TRIPS)
    )


def history(spark: SparkSession, sf_dir: str) -> Tables:
    """The seven relational tables with every yearly snapshot."""
    orders = source(spark, sf_dir, "orders")
    years = orders.selectExpr(f"{SNAPSHOT} AS d").distinct()
    dates = years.agg(F.collect_set("d")).scalar()

    def opened(name: str) -> DataFrame:
        if name == "trips":
            return _trips(orders)
        if name == "stop_times":
            return _stop_times(spark, sf_dir, orders)
        rows = _per_snapshot(spark, sf_dir, name)
        return rows.withColumn("snapshot_date", F.explode(dates))

    return Lazy(schemas.DATASETS, opened).all()


def newest(spark: SparkSession, sf_dir: str) -> Lazy:
    """The same tables at the newest snapshot; its start is pushed into the orders scan."""
    orders = source(spark, sf_dir, "orders")
    year = F.year(F.max("o_orderdate"))
    start = orders.agg(
        F.make_timestamp_ntz(year, *map(F.lit, (1, 1, 0, 0, 0)))
    ).scalar()
    date = orders.agg(F.make_date(year, F.lit(1), F.lit(1))).scalar()
    recent = orders.where(F.col("o_orderdate") >= start)

    def opened(name: str) -> DataFrame:
        if name == "trips":
            return _trips(recent)
        if name == "stop_times":
            return _stop_times(spark, sf_dir, recent)
        return _per_snapshot(spark, sf_dir, name).withColumn("snapshot_date", date)

    return Lazy(schemas.DATASETS, opened)


def _stop_times(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Joined by the id that the calls then go by, so that they lie by ``trip_id``."""
    trip_id, *others = STOP_TIMES
    lines = source(spark, sf_dir, "lineitem").selectExpr(trip_id, "l_partkey", "l_linenumber")
    dated = orders.selectExpr(f"{as_text('o_orderkey')} AS trip_id", "o_orderdate")
    return lines.join(dated.hint("merge"), "trip_id").selectExpr("trip_id", *others)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "events").selectExpr(*ARRIVALS)


# --- dirty feed -----------------------------------------------------------


def padded(x: str, key: str) -> str:
    return (
        f"CASE WHEN {key} % 50 = 0 THEN '   ' WHEN {key} % 7 = 0 THEN concat(chr(9), {x}) "
        f"WHEN {key} % 3 = 0 THEN concat('  ', {x}, ' ') ELSE {x} END"
    )


def dirty_id(x: str, key: str) -> str:
    return f"CASE WHEN {key} % 31 = 0 THEN NULL ELSE {padded(x, key)} END"


def bad(x: str, key: str, word: str = "invalid") -> str:
    return f"CASE WHEN {key} % 11 = 0 THEN '{word}' ELSE {as_text(x)} END"


# dataset -> (driver table, key, row filter or None, expressions)
DIRTY = {
    "agency": (
        "region",
        "r_regionkey",
        None,
        [
            f"{padded('r_name', 'r_regionkey')} AS agency_name",
            "'https://example.org/' AS agency_url",
            "'Europe/Madrid' AS agency_timezone",
            "'ca' AS agency_lang",
            "CAST(NULL AS STRING) AS agency_phone",
        ],
    ),
    "routes": (
        "customer",
        "c_custkey",
        None,
        [
            f"{dirty_id(as_text('c_custkey'), 'c_custkey')} AS route_id",
            f"{padded(SHORT_NAME, 'c_custkey')} AS route_short_name",
            f"{padded('c_name', 'c_custkey')} AS route_long_name",
            f"{bad(ROUTE_TYPE, 'c_custkey')} AS route_type",
            "'https://example.org/r' AS route_url",
            f"lpad({as_text('c_custkey % 1000')}, 6, '0') AS route_color",
            "'FFFFFF' AS route_text_color",
        ],
    ),
    "trips": (
        "orders",
        "o_orderkey",
        None,
        [
            f"{padded(as_text('o_custkey'), 'o_orderkey')} AS route_id",
            f"{as_text('o_orderkey % 25')} AS service_id",
            f"{dirty_id(as_text('o_orderkey'), 'o_orderkey')} AS trip_id",
            f"{padded('o_orderpriority', 'o_orderkey')} AS trip_headsign",
            f"{bad(DIRECTION, 'o_orderkey')} AS direction_id",
            f"concat('S', {as_text('o_custkey % 50')}) AS shape_id",
            f"{as_text('o_orderkey % 3')} AS wheelchair_accessible",
        ],
    ),
    "stops": (
        "part",
        "p_partkey",
        None,
        [
            f"{dirty_id(as_text('p_partkey'), 'p_partkey')} AS stop_id",
            f"lpad({as_text('p_partkey')}, 6, '0') AS stop_code",
            f"{padded('p_name', 'p_partkey')} AS stop_name",
            f"{bad('CASE WHEN p_partkey % 17 = 0 THEN 95 ELSE 41 END', 'p_partkey')} AS stop_lat",
            f"CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE {as_text('2 + p_partkey % 4')} END "
            "AS stop_lon",
            "CAST(NULL AS STRING) AS stop_url",
            f"{as_text('p_size % 3')} AS location_type",
            "CAST(NULL AS STRING) AS parent_station",
            f"{as_text('p_size % 2')} AS wheelchair_boarding",
        ],
    ),
    "stop_times": (
        "lineitem",
        "l_orderkey",
        None,
        [
            f"{dirty_id(as_text('l_orderkey'), 'l_orderkey')} AS trip_id",
            f"{padded(CLOCK % '00', 'l_partkey')} AS arrival_time",
            f"{padded(CLOCK % '01', 'l_partkey')} AS departure_time",
            f"{padded(as_text('l_partkey'), 'l_partkey')} AS stop_id",
            f"{bad('l_linenumber', 'l_partkey')} AS stop_sequence",
        ],
    ),
    "calendar": (
        "nation",
        "n_nationkey",
        None,
        [
            f"{dirty_id(as_text('n_nationkey'), 'n_nationkey')} AS service_id",
            *(f"{as_text(flag(i))} AS {day}" for i, day in enumerate(schemas.WEEKDAYS)),
            "CASE WHEN n_nationkey % 11 = 0 THEN 'bad' ELSE '20260101' END AS start_date",
            "'20261231' AS end_date",
        ],
    ),
    "calendar_dates": (
        "nation",
        "n_nationkey",
        None,
        [
            f"{dirty_id(as_text('n_nationkey'), 'n_nationkey')} AS service_id",
            "CASE WHEN n_nationkey % 11 = 3 THEN 'bad' ELSE '20260914' END AS date",
            f"{as_text('1 + n_nationkey % 2')} AS exception_type",
        ],
    ),
}


def dirty_parts(dataset: str, order: bool = False) -> list[tuple[str | None, list[str]]]:
    """(row filter, expressions) of the original rows and of the appended copies.

    Every 20th row comes twice; for stops, the copy has another name, with quotes in it.
    """
    _, key, keep, expressions = DIRTY[dataset]
    copies = list(expressions)
    if dataset == "stops":
        copies[2] = "'Plaza \"Nova\" 2' AS stop_name"
    parts = []
    for position, (extra, exprs) in enumerate(
        ((None, list(expressions)), (f"{key} % 20 = 0", copies))
    ):
        where = " AND ".join(f"({c})" for c in (keep, extra) if c) or None
        parts.append((where, exprs + ([f"{position} AS ord"] if order else [])))
    return parts


def dirty(
    spark: SparkSession, sf_dir: str, dataset: str, order: bool = False
) -> DataFrame:
    df = source(spark, sf_dir, DIRTY[dataset][0])
    first, copies = (
        (df.where(where) if where else df).selectExpr(*exprs)
        for where, exprs in dirty_parts(dataset, order)
    )
    return first.unionByName(copies)


def dirty_feed(
    spark: SparkSession, sf_dir: str, datasets=schemas.DATASETS
) -> Tables:
    return {name: dirty(spark, sf_dir, name) for name in datasets}


def typed_feed(spark: SparkSession, sf_dir: str, datasets=schemas.DATASETS) -> Tables:
    """The dirty feed as a typed reader would see it."""
    return {
        name: df.select(
            *(
                F.col(f.name).try_cast(f.dataType).alias(f.name)
                for f in schemas.feed_schema(name)
            )
        )
        for name, df in dirty_feed(spark, sf_dir, datasets).items()
    }


# --- arrival messages -----------------------------------------------------

_MINUTES = "CAST(CAST(floor(value * 10 / 60) AS INT) AS STRING)"
# One wait is longer than 32 bits hold.
SECONDS = "CASE WHEN event_id % 109 = 0 THEN 3000000000 ELSE CAST(floor(value * 10) AS BIGINT) END"
_SECONDS = f"CAST({SECONDS} AS STRING)"
# Some times are in nanoseconds or milliseconds.
STAMP = (
    "(1704067200 + event_id) * CASE WHEN event_id % 103 = 0 THEN 1000000000 "
    "WHEN event_id % 107 = 0 THEN 1000 ELSE 1 END"
)
# Which rule a message breaks, in the order the checks run.
BROKEN = (
    ("event_id % 101 = 0", "not_object"),
    ("event_id % 73 = 0", "unexpected_field"),
    ("event_id % 83 = 0", "missing_field"),
    ("event_id % 97 = 0", "blank_field"),
    ("event_id % 103 = 0 OR event_id % 107 = 0", "bad_timestamp"),
    ("event_id % 79 = 0", "not_integer"),
    ("event_id % 89 = 0", "negative"),
)
MESSAGE = (
    "concat("
    "CASE WHEN event_id % 101 = 0 THEN '{broken ' ELSE '{' END, "
    f"'\"timestamp\":', CAST({STAMP} AS STRING), "
    "CASE WHEN event_id % 73 = 0 THEN ',\"speed\":1' ELSE '' END, "
    "',\"destination\":\" to ', event_type, ' \"', "
    "CASE WHEN event_id % 83 = 0 THEN ',\"line\":null' "
    "WHEN event_id % 97 = 0 THEN ',\"line\":\"  \"' "
    "ELSE concat(',\"line\":\" ', event_type, '\"') END, "
    "',\"route_id\":\"', CAST(user_id AS STRING), "
    "'\",\"stop\":\"', CAST(user_id % 50 AS STRING), "
    f"'\",\"time_in_minutes\":', {_MINUTES}, ',\"time_in_seconds\":', "
    "CASE WHEN event_id % 79 = 0 THEN '\"12\"' WHEN event_id % 89 = 0 THEN '-1' "
    f"ELSE {_SECONDS} END, "
    f"',\"text_ca\":\"', {_MINUTES}, ' min\"}}')"
)
PAYLOAD = (
    "concat('{\"data\":{\"ibus\":[{\"destination\":\"to ', event_type, "
    "'\",\"line\":\"', event_type, '\",\"routeId\":\"', CAST(user_id AS STRING), "
    "'\",\"stop\":\"', CAST(user_id % 50 AS STRING), "
    f"'\",\"t-in-min\":', {_MINUTES}, ',\"t-in-s\":', {_SECONDS}, "
    f"',\"text-ca\":\"', {_MINUTES}, ' min\"}}', "
    "CASE WHEN event_id % 2 = 0 THEN concat(',{\"line\":\"', event_type, '\"}') "
    "ELSE '' END, ']}}')"
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: one JSON message per event, some of them broken."""
    return source(spark, sf_dir, "events").selectExpr("event_id", f"{MESSAGE} AS value")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "events").selectExpr(f"{PAYLOAD} AS value")


# --- the same as SQL text -------------------------------------------------


def ctes() -> dict[str, str]:
    """Every view as a SELECT over the driver tables."""
    out = {"snapshots": f"SELECT DISTINCT {SNAPSHOT} AS snapshot_date FROM orders"}
    for view, (table, keep, expressions) in PER_SNAPSHOT.items():
        where = f" WHERE {keep}" if keep else ""
        out[view] = (
            f"SELECT {', '.join(expressions)}, s.snapshot_date "
            f"FROM {table}, snapshots s{where}"
        )
    for view, (table, _, expressions) in EXTRA.items():
        out[view] += (
            f" UNION ALL SELECT {', '.join(expressions)}, s.snapshot_date FROM {table}, snapshots s"
        )
    out["g_trips"] = (
        f"SELECT {', '.join(TRIPS)} FROM orders UNION ALL "
        f"SELECT {', '.join(EXTRA_TRIPS)} FROM orders WHERE {EXTRA_TRIPS_OF}"
    )
    out["g_stop_times"] = (
        f"SELECT {', '.join(STOP_TIMES)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    )
    out["arrivals"] = f"SELECT {', '.join(ARRIVALS)} FROM events"
    for dataset, (table, *_rest) in DIRTY.items():
        for view, order in ((f"d_{dataset}", False), (f"o_{dataset}", True)):
            out[view] = " UNION ALL ".join(
                f"SELECT {', '.join(exprs)} FROM {table}"
                + (f" WHERE {where}" if where else "")
                for where, exprs in dirty_parts(dataset, order)
            )
        typed = ", ".join(
            f"TRY_CAST({f.name} AS {f.dataType.simpleString().upper()}) AS {f.name}"
            for f in schemas.feed_schema(dataset)
        )
        out[f"t_{dataset}"] = f"SELECT {typed} FROM d_{dataset}"
    code = " ".join(f"WHEN {rule} THEN '{name}'" for rule, name in BROKEN)
    out["msg"] = (
        f"SELECT event_id, user_id, event_type, CAST({STAMP} AS BIGINT) AS stamp, "
        f"CAST(floor(value * 10 / 60) AS BIGINT) AS mins, CAST({SECONDS} AS BIGINT) AS secs, "
        f"{MESSAGE} AS value, CASE {code} END AS error_code FROM events"
    )
    return out
