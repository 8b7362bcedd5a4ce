"""Arrival messages as columns.

Every function maps a frame to a frame without shuffles, and works the same on a
batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline import schemas
from tramline.functions.aggregates import count_true
from tramline.functions.text import is_blank

ALERT_SECONDS = 600
# The last second of the year 9999; larger numbers are not seconds (milliseconds, say).
LAST_TIMESTAMP = 253_402_300_799

FIELDS = tuple(schemas.ARRIVAL_MESSAGE.fieldNames())
OPTIONAL = ("destination", "text_ca")
REQUIRED = tuple(f for f in FIELDS if f not in OPTIONAL)
TEXTS = ("line", "route_id", "stop")
DURATIONS = ("time_in_minutes", "time_in_seconds")

MESSAGE = "_message"
CHECKS = ("error_code", "error_field", "error_message", "wait_seconds")

# Message field <- feed field.
FEED_FIELDS = {
    "destination": "destination",
    "line": "line",
    "route_id": "routeId",
    "stop": "stop",
    "time_in_minutes": "t-in-min",
    "time_in_seconds": "t-in-s",
    "text_ca": "text-ca",
}

# Texts of the published error and alert records. The names of
# unexpected and missing fields follow their text.
NOT_OBJECT = "El evento GTFS-RT debe ser un objeto JSON."
UNEXPECTED = "El evento GTFS-RT contiene campos no esperados: "
MISSING = "El evento GTFS-RT no contiene campos obligatorios: "
BLANK = "El campo %s no puede estar vacío."
BAD_TIMESTAMP = "El timestamp del evento GTFS-RT no es válido."
NOT_INTEGER = "El campo %s debe ser un entero."
NEGATIVE = "El campo %s no puede ser negativo."
ALERT = "La espera estimada de llegada supera %s segundos."


def normalise_feed(payloads: DataFrame, ingested: Column | None = None) -> DataFrame:
    """One JSON message per bus of each feed payload (column ``value``).

    JSON types pass through unchanged, so the checks still see them. Absent
    fields become null; a payload without buses yields nothing.
    """
    ingested = F.unix_timestamp(F.current_timestamp()) if ingested is None else ingested
    buses = payloads.select(
        ingested.cast("bigint").alias("timestamp"),
        F.explode(
            F.from_json(
                F.col("value").cast("string"), "data STRUCT<ibus ARRAY<VARIANT>>"
            )["data"]["ibus"]
        ).alias("bus"),
    )
    message = F.struct(
        "timestamp",
        *(
            F.try_variant_get("bus", f'$["{source}"]', "variant").alias(name)
            for name, source in FEED_FIELDS.items()
        ),
    )
    return buses.select(F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read instead of repeating its expression.

    The optimizer copies the expression behind a projected column into every
    filter above it, so a filter on six parsed fields would parse each message
    six times more. It does not look inside the one-element explode used here.
    """
    held = df.withColumn("_once", value)
    return held.select(*df.columns, F.explode(F.array("_once")).alias(name))


def check_messages(messages: DataFrame) -> DataFrame:
    """The messages with ``error_code, error_field, error_message, wait_seconds``.

    The error columns are NULL when the message is valid.

    The first broken rule counts. Types are those of the JSON text: ``"4"`` and
    ``4.0`` are not integers, and neither is ``true``.
    """
    parsed = computed_once(
        messages.withColumn("value", F.col("value").cast("string")),
        "_v",
        F.try_parse_json("value"),
    )
    keys = F.json_object_keys("value")
    facts = F.struct(
        (F.col("_v").isNotNull() & keys.isNotNull()).alias("is_object"),
        F.array_join(
            F.sort_array(F.array_except(keys, F.array(*map(F.lit, FIELDS)))), ", "
        ).alias("extra"),
        *(F.schema_of_variant(_value(f, "variant")).alias(f"kind_{f}") for f in REQUIRED),
        *(is_blank(_value(f, "string")).alias(f"blank_{f}") for f in TEXTS),
        *(_value(f, "bigint").alias(f"number_{f}") for f in ("timestamp", *DURATIONS)),
    )
    typed = computed_once(parsed, "_m", facts)
    # array_join skips the NULLs of the fields that are there
    missing = F.array_join(
        F.array(*(F.when(_absent(f), F.lit(f)) for f in sorted(REQUIRED))), ", "
    )

    # (condition, code, field, message); the first match wins. The two rules on sets
    # of fields have no fixed field, it is added to the message below.
    rules: list[tuple[Column, str, str | None, str]] = [
        (~F.col("_m.is_object"), "not_object", None, NOT_OBJECT),
        (F.col("_m.extra") != "", "unexpected_field", None, UNEXPECTED),
        (F.col("_missing") != "", "missing_field", None, MISSING),
    ]
    for f in TEXTS:
        blank = (F.col(f"_m.kind_{f}") != "STRING") | F.col(f"_m.blank_{f}")
        rules.append((blank, "blank_field", f, BLANK % f))
    time = _number("timestamp")
    bad_time = _not_integer("timestamp") | (time <= 0) | (time > LAST_TIMESTAMP)
    rules.append((bad_time, "bad_timestamp", "timestamp", BAD_TIMESTAMP))
    for f in DURATIONS:
        rules.append((_not_integer(f), "not_integer", f, NOT_INTEGER % f))
        rules.append((_number(f) < 0, "negative", f, NEGATIVE % f))

    conditions, codes, fields, texts = zip(*rules)
    first = F.coalesce(*(F.when(c, F.lit(i)) for i, c in enumerate(conditions)))
    judged = computed_once(typed.withColumn("_missing", missing), "_rule", first)

    def of_rule(values) -> Column:
        return F.get(F.array(*(F.lit(v).cast("string") for v in values)), F.col("_rule"))

    named = F.when(F.col("_rule") == 1, F.col("_m.extra")).when(
        F.col("_rule") == 2, F.col("_missing")
    )
    return judged.select(
        *messages.columns,
        of_rule(codes).alias("error_code"),
        F.coalesce(named, of_rule(fields)).alias("error_field"),
        F.concat(of_rule(texts), F.coalesce(named, F.lit(""))).alias("error_message"),
        F.col("_m.number_time_in_seconds").alias("wait_seconds"),
    )


def _value(field: str, kind: str) -> Column:
    return F.try_variant_get("_v", f"$.{field}", kind)


def _absent(field: str) -> Column:
    kind = F.col(f"_m.kind_{field}")
    return kind.isNull() | (kind == "VOID")


def _not_integer(field: str) -> Column:
    return F.col(f"_m.kind_{field}") != "BIGINT"


def _number(field: str) -> Column:
    return F.col(f"_m.number_{field}")


def valid(checked: DataFrame) -> DataFrame:
    return checked.where("error_code IS NULL").drop(*CHECKS)


def error_records(checked: DataFrame, now: Column | None = None) -> DataFrame:
    """Rejected messages with the reason and the untouched original.

    The time is the event's own, even if null; only an event without one gets
    the present.
    """
    now = F.unix_timestamp(F.current_timestamp()) if now is None else now
    event = F.try_parse_json("value")
    own = F.array_contains(F.json_object_keys("value"), "timestamp")
    stamp = F.when(own, F.try_variant_get(event, "$.timestamp", "bigint")).otherwise(now)
    return checked.where("error_code IS NOT NULL").select(
        stamp.alias("timestamp"),
        F.lit("validation_error").alias("error_type"),
        "error_code",
        "error_field",
        "error_message",
        F.col("value").alias("event"),
    )


def error_messages(errors: DataFrame) -> DataFrame:
    """Error records as JSON messages; the event is nested, as text if it is no JSON."""
    event = F.coalesce(
        F.try_parse_json("event"), F.col("event").cast("variant")
    )
    record = F.struct(
        "timestamp", "error_type", "error_message", event.alias("event")
    )
    return errors.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def with_message(checked: DataFrame) -> DataFrame:
    """Checked messages with their fields in one more column, for ``parse_messages``.

    A frame that is kept this way feeds several outputs and parses each message once.
    """
    parsed = F.from_json(F.col("value").cast("string"), schemas.ARRIVAL_MESSAGE)
    return checked.withColumn(MESSAGE, parsed)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message fields as columns; malformed text yields NULLs, never an error."""
    if MESSAGE in messages.columns:
        return messages.select(f"{MESSAGE}.*")
    parsed = F.from_json(F.col("value").cast("string"), schemas.ARRIVAL_MESSAGE)
    return computed_once(messages.select("value"), "m", parsed).select("m.*")


def clean_arrivals(parsed: DataFrame) -> DataFrame:
    """Trimmed, renamed and ordered as the arrivals table.

    A number that is no second of the years up to 9999 has no time: NULL.
    """
    known = F.col("timestamp").between(-LAST_TIMESTAMP, LAST_TIMESTAMP)
    return parsed.select(
        F.timestamp_seconds(F.when(known, F.col("timestamp"))).alias("event_timestamp"),
        F.trim("destination").alias("destination"),
        F.trim("line").alias("line"),
        F.trim("route_id").alias("route_id"),
        F.trim("stop").alias("stop_id"),
        F.col("time_in_minutes").alias("arrival_minutes"),
        F.col("time_in_seconds").alias("arrival_seconds"),
        F.trim("text_ca").alias("arrival_text"),
    )


def usable_arrivals(arrivals: DataFrame) -> DataFrame:
    """Rows with every required field and no negative time."""
    needed = (
        "event_timestamp",
        "line",
        "route_id",
        "stop_id",
        "arrival_minutes",
        "arrival_seconds",
    )
    return arrivals.dropna(subset=list(needed)).where(
        "arrival_minutes >= 0 AND arrival_seconds >= 0"
    )


def arrivals(messages: DataFrame) -> DataFrame:
    return usable_arrivals(clean_arrivals(parse_messages(messages)))


def alerts(parsed: DataFrame, threshold: int = ALERT_SECONDS) -> DataFrame:
    """One alert per parsed valid message whose wait is longer than the threshold."""
    return parsed.where(F.col("time_in_seconds") > threshold).select(
        "timestamp",
        F.lit("critical_arrival_wait").alias("alert_type"),
        F.lit("critical").alias("severity"),
        "line",
        "route_id",
        "stop",
        "time_in_seconds",
        "destination",
        F.lit(ALERT % threshold).alias("message"),
    )


def alert_messages(records: DataFrame) -> DataFrame:
    return records.select(
        F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def counters(checked: DataFrame, threshold: int = ALERT_SECONDS) -> DataFrame:
    """Messages sent and rejected, alerts and errors of one cycle, in one row."""
    good = F.col("error_code").isNull()
    return checked.agg(
        count_true(good).alias("messages_sent"),
        count_true(~good).alias("messages_rejected"),
        count_true(good & (F.col("wait_seconds") > threshold)).alias("alerts_sent"),
        count_true(~good).alias("errors_sent"),
    )
