"""Arrival messages: checks, routing, the streaming query; and guarded SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks import stored, views
from checks.registry import add
from tramline.functions.aggregates import union_all
from tramline.plans import adhoc, realtime
from tramline.session import scratch_dir
from tramline.sources import tables
from tramline.streaming import compaction, events, jobs, windows


def _checked(spark, sf):
    return events.check_messages(views.messages(spark, sf))


def _valid(spark, sf):
    return events.valid(_checked(spark, sf))


def _no_zone(df, name="event_timestamp"):
    """The instant as UTC wall time, as the oracle prints it."""
    local = F.col(name).cast("timestamp_ntz")
    return df.withColumn(name, F.convert_timezone(None, F.lit("UTC"), local))


MINS = "CAST(mins AS STRING) || ' min'"
AT = "make_timestamp(stamp * 1000000)"
GOOD = "FROM msg WHERE error_code IS NULL"
FIELD = (
    "CASE error_code WHEN 'unexpected_field' THEN 'speed' WHEN 'missing_field' THEN 'line' "
    "WHEN 'blank_field' THEN 'line' WHEN 'bad_timestamp' THEN 'timestamp' "
    "WHEN 'not_integer' THEN 'time_in_seconds' "
    "WHEN 'negative' THEN 'time_in_seconds' END"
)
TEXT = (
    "CASE error_code WHEN 'not_object' THEN 'El evento GTFS-RT debe ser un objeto JSON.' "
    "WHEN 'unexpected_field' THEN 'El evento GTFS-RT contiene campos no esperados: speed' "
    "WHEN 'missing_field' THEN 'El evento GTFS-RT no contiene campos obligatorios: line' "
    "WHEN 'blank_field' THEN 'El campo line no puede estar vacío.' "
    "WHEN 'bad_timestamp' THEN 'El timestamp del evento GTFS-RT no es válido.' "
    "WHEN 'not_integer' THEN 'El campo time_in_seconds debe ser un entero.' "
    "WHEN 'negative' THEN 'El campo time_in_seconds no puede ser negativo.' END"
)
ARRIVALS = (
    f"SELECT {AT} AS event_timestamp, 'to ' || event_type AS destination, "
    "event_type AS line, CAST(user_id AS STRING) AS route_id, "
    "CAST(user_id % 50 AS STRING) AS stop_id, mins AS arrival_minutes, "
    f"secs AS arrival_seconds, {MINS} AS arrival_text {GOOD}"
)
# Alerts keep the message's own, untrimmed texts.
ALERTS = (
    "SELECT stamp AS timestamp, 'critical_arrival_wait' AS alert_type, "
    "'critical' AS severity, ' ' || event_type AS line, CAST(user_id AS STRING) AS route_id, "
    "CAST(user_id % 50 AS STRING) AS stop, secs AS time_in_seconds, "
    "' to ' || event_type || ' ' AS destination, "
    "'La espera estimada de llegada supera 600 segundos.' AS message "
    f"{GOOD} AND secs > 600"
)
ERRORS = (
    "SELECT CASE WHEN error_code = 'not_object' THEN 7 ELSE stamp END AS timestamp, "
    f"'validation_error' AS error_type, error_code, {FIELD} AS error_field, "
    f"{TEXT} AS error_message, value AS event FROM msg WHERE error_code IS NOT NULL"
)
COUNTERS = (
    "SELECT count(*) FILTER (WHERE error_code IS NULL) AS messages_sent, "
    "count(*) FILTER (WHERE error_code IS NOT NULL) AS messages_rejected, "
    "count(*) FILTER (WHERE error_code IS NULL AND secs > 600) AS alerts_sent, "
    "count(*) FILTER (WHERE error_code IS NOT NULL) AS errors_sent FROM msg"
)

# --- batch twins of the stream --------------------------------------------


def _json(field: str, value: str) -> str:
    return f"'\"{field}\":' || {value}"


BUS = " || ',' || ".join(
    (
        "'{\"timestamp\":7'",
        _json("destination", "{dest}"),
        _json("line", "'\"' || event_type || '\"'"),
        _json("route_id", "{route}"),
        _json("stop", "{stop}"),
        _json("time_in_minutes", "{mins}"),
        _json("time_in_seconds", "{secs}"),
        _json("text_ca", "{text}"),
    )
) + " || '}}'"


def _bus(**values) -> str:
    out = BUS.replace("}}", "}")
    for name, value in values.items():
        out = out.replace("{" + name + "}", value)
    return out


add(
    "e01_normalise_feed",
    lambda spark, sf: events.normalise_feed(views.payloads(spark, sf), F.lit(7)),
    "SELECT "
    + _bus(
        dest="'\"to ' || event_type || '\"'",
        route="'\"' || CAST(user_id AS STRING) || '\"'",
        stop="'\"' || CAST(user_id % 50 AS STRING) || '\"'",
        mins="CAST(mins AS STRING)",
        secs="CAST(secs AS STRING)",
        text=f"'\"' || {MINS} || '\"'",
    )
    + " AS value FROM msg UNION ALL SELECT "
    + _bus(
        dest="'null'", route="'null'", stop="'null'", mins="'null'", secs="'null'", text="'null'"
    )
    + " FROM msg WHERE event_id % 2 = 0",
)
add(
    "e02_check_messages",
    lambda spark, sf: _checked(spark, sf).drop("wait_seconds"),
    f"SELECT event_id, value, error_code, {FIELD} AS error_field, {TEXT} AS error_message "
    "FROM msg",
)
add(
    "e02_error_classes",
    lambda spark, sf: _checked(spark, sf)
    .groupBy("error_code")
    .agg(F.count(F.lit(1)).alias("n")),
    "SELECT error_code, count(*) AS n FROM msg GROUP BY 1",
)
add(
    "e03_error_records",
    lambda spark, sf: events.error_records(_checked(spark, sf), F.lit(7).cast("bigint")),
    ERRORS,
)
add(
    "e04_alerts",
    lambda spark, sf: events.alerts(events.parse_messages(_valid(spark, sf))),
    ALERTS,
)
add("e05_cycle_counters", lambda spark, sf: events.counters(_checked(spark, sf)), COUNTERS)
_IF_JSON = "CASE WHEN error_code = 'not_object' THEN NULL ELSE {} END"
add(
    "e06_parse_messages",
    lambda spark, sf: events.parse_messages(views.messages(spark, sf)),
    "SELECT "
    + ", ".join(
        f"{_IF_JSON.format(value)} AS {name}"
        for name, value in (
            ("timestamp", "stamp"),
            ("destination", "' to ' || event_type || ' '"),
            (
                "line",
                "CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 97 = 0 THEN '  ' "
                "ELSE ' ' || event_type END",
            ),
            ("route_id", "CAST(user_id AS STRING)"),
            ("stop", "CAST(user_id % 50 AS STRING)"),
            ("time_in_minutes", "mins"),
            (
                "time_in_seconds",
                "CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -1 "
                "ELSE secs END",
            ),
            ("text_ca", MINS),
        )
    )
    + " FROM msg",
)
add(
    "e07_clean_arrivals",
    lambda spark, sf: _no_zone(
        events.clean_arrivals(events.parse_messages(_valid(spark, sf)))
    ),
    ARRIVALS,
)
# Without the checks before it, the last filter keeps blank lines and extra fields.
add(
    "e08_usable_arrivals",
    lambda spark, sf: _no_zone(events.arrivals(views.messages(spark, sf))),
    ARRIVALS.replace(
        "event_type AS line",
        "CASE WHEN event_id % 97 = 0 THEN '' ELSE event_type END AS line",
    ).replace(
        GOOD,
        "FROM msg WHERE event_id % 101 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0 "
        "AND event_id % 89 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0",
    ),
)


def _topics(spark, sf):
    checked = _checked(spark, sf)
    return union_all(
        [
            df.groupBy().agg(F.count("value").alias("messages")).withColumn(
                "topic", F.lit(topic)
            )
            for topic, df in jobs.topics(checked).items()
        ]
    )


add(
    "k05_topic_counts",
    _topics,
    f"SELECT 'gtfs-realtime' AS topic, count(*) AS messages {GOOD} UNION ALL "
    f"SELECT 'transport-alerts', count(*) {GOOD} AND secs > 600 UNION ALL "
    "SELECT 'transport-errors', count(*) FROM msg WHERE error_code IS NOT NULL",
)
add(
    "k05_alert_messages",
    lambda spark, sf: jobs.topics(_checked(spark, sf))[jobs.ALERTS_TOPIC],
    "SELECT '{\"timestamp\":' || timestamp || ',\"alert_type\":\"' || alert_type || "
    "'\",\"severity\":\"' || severity || '\",\"line\":\"' || line || '\",\"route_id\":\"' || "
    "route_id || '\",\"stop\":\"' || stop || '\",\"time_in_seconds\":' || time_in_seconds || "
    "',\"destination\":\"' || destination || '\",\"message\":\"' || message || '\"}' AS value "
    f"FROM ({ALERTS})",
)

# --- the query itself -----------------------------------------------------


def _stored(name):
    return lambda spark, sf: tables.read_table(
        spark, f"{stored.stream_root(spark, sf)}/{name}"
    ).drop("query_id", "batch_id")


add(
    "e09_stream_arrivals",
    lambda spark, sf: _no_zone(
        _stored("arrivals")(spark, sf).drop("created_at", "event_date")
    ),
    ARRIVALS,
)
add(
    "r01_stored_arrivals_per_line",
    lambda spark, sf: realtime.arrivals_per_line(
        _stored("arrivals")(spark, sf), realtime.NEWEST
    ),
    "SELECT line, count(*) AS total_llegadas FROM ok WHERE event_timestamp >= "
    "(SELECT max(event_timestamp) FROM ok) - INTERVAL 1 HOUR GROUP BY 1",
    ok=ARRIVALS,
)
add("e09_stream_alerts", _stored("alerts"), ALERTS)
add(
    "e09_stream_errors",
    lambda spark, sf: _stored("errors")(spark, sf).withColumn(
        "timestamp",
        F.when(F.col("error_code") == "not_object", F.lit(7)).otherwise(F.col("timestamp")),
    ),
    ERRORS,
)
add("e09_stream_cycles", _stored("cycles"), COUNTERS)


def _replayed(spark, sf):
    """Two batches, each delivered twice, and one without rows."""
    path = scratch_dir(spark, "arrivals")
    write = jobs.arrivals_writer(path)
    df = events.arrivals(_valid(spark, sf))
    for batch, rows in enumerate(
        (df.where("arrival_seconds > 600"), df.where("arrival_seconds <= 600"), df.limit(0))
    ):
        for _ in range(2):
            write(rows, batch)
    return tables.read_table(spark, path).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("created_at").alias("stamped")
    )


add(
    "k04_append_arrivals",
    lambda spark, sf: _replayed(spark, sf).withColumn(
        "batch_id", F.col("batch_id").cast("bigint")
    ),
    "SELECT CAST(b AS BIGINT) AS batch_id, count(*) AS rows, count(*) AS stamped FROM "
    f"(SELECT CASE WHEN arrival_seconds > 600 THEN 0 ELSE 1 END AS b FROM ({ARRIVALS})) "
    "GROUP BY 1",
)
def _compacted(spark, sf):
    """Arrivals of two batches, merged; one is replayed, and rows come late in a third."""
    path, root = scratch_dir(spark, "arrivals"), scratch_dir(spark, "closed")
    write = jobs.arrivals_writer(path)
    df = events.arrivals(_valid(spark, sf))
    batches = (
        df.where("arrival_seconds > 600"),
        df.where("arrival_seconds BETWEEN 300 AND 600"),
        df.where("arrival_seconds < 300"),
    )
    for batch in (0, 1):
        write(batches[batch], batch)
    compaction.compact(spark, path, root, "9999-12-31")
    write(batches[1], 1)
    compaction.sweep(spark, path, root)
    write(batches[0], 0)
    write(batches[2], 2)
    return compaction.read_arrivals(spark, path, root)


add(
    "k04_compacted_arrivals",
    lambda spark, sf: _no_zone(_compacted(spark, sf).drop("created_at", "event_date", "query_id", "batch_id")),
    ARRIVALS,
)
def _streamed(spark, parts, build, mode):
    """Parts of a table as batches of a stream that is started anew for each."""
    path = scratch_dir(spark, "windows")
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(part.schema).parquet(f"{path}/in")
        windows.start(build(source), f"{path}/out", f"{path}/checkpoint", mode, once=True).awaitTermination()
    return f"{path}/out"


def _stream_windows(spark, sf):
    """Arrivals in three batches by time, so that minutes go on from batch to batch."""
    df = events.arrivals(_valid(spark, sf))
    day = F.unix_seconds(F.col("event_timestamp").cast("timestamp"))
    low, high = df.select(day.cast("double").alias("t")).approxQuantile("t", [1 / 3, 2 / 3], 0.01)
    parts = (df.where(day <= low), df.where((day > low) & (day <= high)), df.where(day > high))
    out = _streamed(spark, parts, windows.minutes, "update")
    return _no_zone(windows.minute_counts(spark, out), "minuto")


add(
    "r02_stream_windows",
    _stream_windows,
    "SELECT date_trunc('minute', event_timestamp) AS minuto, line, count(*) AS total_llegadas FROM ok "
    "WHERE event_timestamp IS NOT NULL GROUP BY 1, 2",
    ok=ARRIVALS,
)


def _polled_again(spark, sf):
    """All arrivals fed three times, with a restart before each."""
    df = events.arrivals(_valid(spark, sf))
    out = _streamed(spark, (df, df, df), windows.distinct_predictions, "append")
    return _no_zone(spark.read.parquet(out).select(*windows.PREDICTION), "predicted")


add(
    "e07_stream_distinct_predictions",
    _polled_again,
    "SELECT DISTINCT line, route_id, stop_id, event_timestamp + to_seconds(arrival_seconds) AS predicted FROM ok "
    "WHERE event_timestamp IS NOT NULL",
    ok=ARRIVALS,
)
add(
    "s06_text_source",
    lambda spark, sf: _stored("cycles")(spark, sf).select(
        (F.col("messages_sent") + F.col("messages_rejected")).alias("messages")
    ),
    "SELECT count(*) AS messages FROM msg",
)



def _two_queries(spark, sf):
    """Two streaming queries, each with its own checkpoint, that write to one root."""
    path = scratch_dir(spark, "two")
    rows = views.messages(spark, sf)
    for part in (0, 1):
        rows.where(F.col("event_id") % 2 == part).select("value").write.text(f"{path}/in{part}")
        jobs.start(
            jobs.text_source(spark, f"{path}/in{part}"),
            jobs.fan_out(jobs.table_writers(f"{path}/out")),
            f"{path}/checkpoint{part}",
            once=True,
        ).awaitTermination()
    return _no_zone(
        tables.read_table(spark, f"{path}/out/arrivals").drop(
            "created_at", "event_date", "query_id", "batch_id"
        )
    )


add("k04_two_queries_one_table", _two_queries, ARRIVALS)

# --- guarded SQL ----------------------------------------------------------

QUESTION = (
    "SELECT r.route_short_name, t.direction_id, count(*) AS viajes FROM fact_trip t "
    "JOIN dim_route r ON r.route_key = t.route_key "
    "GROUP BY r.route_short_name, t.direction_id"
)


def _session(spark, sf):
    root = stored.star_root(spark, sf)
    return adhoc.isolated_session(
        spark, {n: f"{root}/{n}" for n in ("dim_route", "dim_stop", "fact_trip")}
    )


add(
    "g01_guarded_limit",
    lambda spark, sf: adhoc.run(
        _session(spark, sf),
        "SELECT stop_id, stop_name, snapshot_date FROM dim_stop "
        "ORDER BY stop_id, snapshot_date LIMIT 1000000",
    ),
    "SELECT stop_id, stop_name, snapshot_date FROM g_stops "
    "ORDER BY stop_id, snapshot_date LIMIT 2000",
)
add(
    "g02_visible_tables",
    lambda spark, sf: adhoc.run(
        _session(spark, sf),
        "SELECT 'dim_stop' AS name, count(*) AS n FROM dim_stop UNION ALL "
        "SELECT 'fact_trip', count(*) FROM fact_trip",
    ),
    "SELECT 'dim_stop' AS name, count(*) AS n FROM g_stops UNION ALL "
    "SELECT 'fact_trip', count(*) FROM s_trip",
)


def _from_json(spark, sf):
    """The rows of the JSON answer as a table again."""
    answer = json.loads(adhoc.run_json(_session(spark, sf), QUESTION))
    rows = [tuple(row[c] for c in answer["columns"]) for row in answer["rows"]]
    return spark.createDataFrame(
        rows, "route_short_name STRING, direction_id INT, viajes BIGINT"
    )


add(
    "g03_guarded_query",
    _from_json,
    "SELECT route_short_name, direction_id, count(*) AS viajes FROM s_trip "
    "JOIN g_routes USING (route_id, snapshot_date) GROUP BY 1, 2",
)


def _context(spark, sf):
    return adhoc.context(
        _session(spark, sf), views.history(spark, sf)["trips"], views.arrivals(spark, sf)
    )


add(
    "g04_context",
    _context,
    "SELECT 'dim_route, dim_stop, fact_trip' AS tables, "
    "CAST(max(snapshot_date) AS STRING) AS latest_snapshot, "
    "count(*) AS trips_in_latest_table, (SELECT count(*) FROM arrivals) AS realtime_arrivals "
    "FROM g_trips",
)
