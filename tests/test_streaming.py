import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tramline.streaming import events, jobs

VALID = {
    "timestamp": 1770000123,
    "destination": "Harbour",
    "line": "N7",
    "route_id": "31-b",
    "stop": "88",
    "time_in_minutes": 6,
    "time_in_seconds": 390,
    "text_ca": "6 min",
}


@pytest.fixture
def messages(frame):
    def build(*events_):
        texts = (e if isinstance(e, str) else json.dumps(e) for e in events_)
        return frame("value STRING", *((t,) for t in texts))

    return build


def verdict(df):
    (row,) = events.check_messages(df).collect()
    return row.error_code, row.error_field, row.error_message


def test_valid_message_passes_unchanged(messages):
    assert verdict(messages(VALID)) == (None, None, None)
    kept = events.valid(events.check_messages(messages(VALID)))
    assert json.loads(kept.first()["value"]) == VALID
    assert kept.columns == ["value"]


@pytest.mark.parametrize("field", events.REQUIRED)
def test_null_or_absent_required_field(messages, field):
    for event in (VALID | {field: None}, {k: v for k, v in VALID.items() if k != field}):
        code, named, text = verdict(messages(event))
        assert (code, named) == ("missing_field", field)
        assert "campos obligatorios" in text


@pytest.mark.parametrize(
    "change, code, field",
    [
        ({"time_in_seconds": -1}, "negative", "time_in_seconds"),
        ({"time_in_minutes": -1}, "negative", "time_in_minutes"),
        ({"unknown": "value", "also": 1}, "unexpected_field", "also, unknown"),
        ({"line": "  "}, "blank_field", "line"),
        ({"stop": "\t\u00a0"}, "blank_field", "stop"),
        ({"route_id": 12}, "blank_field", "route_id"),
        ({"timestamp": 0}, "bad_timestamp", "timestamp"),
        ({"timestamp": "1770000123"}, "bad_timestamp", "timestamp"),
        ({"timestamp": True}, "bad_timestamp", "timestamp"),
        ({"timestamp": 1770000123000}, "bad_timestamp", "timestamp"),
        ({"timestamp": 1770000123000000000}, "bad_timestamp", "timestamp"),
        ({"time_in_minutes": "4"}, "not_integer", "time_in_minutes"),
        ({"time_in_seconds": 4.0}, "not_integer", "time_in_seconds"),
        ({"time_in_seconds": True}, "not_integer", "time_in_seconds"),
        ({"time_in_minutes": -1, "time_in_seconds": "x"}, "negative", "time_in_minutes"),
        ({"unknown": 1, "line": None}, "unexpected_field", "unknown"),
        ({"line": None, "stop": None}, "missing_field", "line, stop"),
        ({"line": " ", "timestamp": -5}, "blank_field", "line"),
    ],
)
def test_first_broken_rule(messages, change, code, field):
    assert verdict(messages(VALID | change))[:2] == (code, field)


@pytest.mark.parametrize("text", ["[1]", '"x"', "not json", "", "3", '{"a":'])
def test_anything_but_an_object(messages, text):
    assert verdict(messages(text))[0] == "not_object"


def test_optional_fields_may_be_missing(messages):
    event = {k: v for k, v in VALID.items() if k not in events.OPTIONAL}
    assert verdict(messages(event))[0] is None


def test_error_record_keeps_the_event_and_its_time(messages):
    no_time = {"route_id": None, "stop": "88"}
    null_time = VALID | {"timestamp": None}
    checked = events.check_messages(
        messages(no_time, null_time, VALID | {"line": ""}, "broken", VALID)
    )
    records = {r.event: r for r in events.error_records(checked, F.lit(7)).collect()}
    assert len(records) == 4
    assert records[json.dumps(no_time)].timestamp == 7
    assert records[json.dumps(null_time)].timestamp is None
    assert records["broken"].timestamp == 7
    sent = [
        json.loads(r.value)
        for r in events.error_messages(events.error_records(checked, F.lit(7))).collect()
    ]
    by_event = {json.dumps(m["event"]): m for m in sent}
    assert by_event[json.dumps(no_time)]["error_type"] == "validation_error"
    assert '"broken"' in by_event
    assert set(sent[0]) == {"timestamp", "error_type", "error_message", "event"}


@pytest.mark.parametrize("seconds, count", [(600, 0), (601, 1)])
def test_alert_boundary(messages, seconds, count):
    parsed = events.parse_messages(messages(VALID | {"time_in_seconds": seconds}))
    alerts = events.alerts(parsed).collect()
    assert len(alerts) == count
    if alerts:
        assert alerts[0].alert_type == "critical_arrival_wait"
        assert alerts[0].severity == "critical"
        assert alerts[0].time_in_seconds == 601


def test_feed_payload(messages):
    payload = {
        "data": {
            "ibus": [
                {"routeId": "1", "t-in-min": "4", "t-in-s": 5, "text-ca": "x", "other": 1},
                {},
            ]
        }
    }
    out = [
        json.loads(r.value)
        for r in events.normalise_feed(
            messages(payload, {"data": {}}, {}, "junk"), F.lit(9)
        ).collect()
    ]
    empty = dict.fromkeys(VALID) | {"timestamp": 9}
    assert out == [
        empty
        | {"route_id": "1", "time_in_minutes": "4", "time_in_seconds": 5, "text_ca": "x"},
        empty,
    ]


def test_arrival_table_columns(messages):
    df = events.arrivals(messages(VALID | {"line": " N7 "}, "junk", VALID | {"line": None}))
    (row,) = df.collect()
    assert row.line == "N7" and row.stop_id == "88" and row.arrival_seconds == 390
    assert df.columns == [
        "event_timestamp",
        "destination",
        "line",
        "route_id",
        "stop_id",
        "arrival_minutes",
        "arrival_seconds",
        "arrival_text",
    ]


def test_timestamps_do_not_collapse_in_the_autumn_hour(spark, messages):
    df = events.clean_arrivals(
        events.parse_messages(
            messages(VALID | {"timestamp": 1792888200}, VALID | {"timestamp": 1792891800})
        )
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
        stamps = df.select(F.unix_timestamp("event_timestamp")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(r[0] for r in stamps) == [1792888200, 1792891800]


def start(spark, folder, **kwargs):
    query = jobs.start(
        jobs.text_source(spark, str(folder / "in"), files_per_trigger=1),
        jobs.fan_out(jobs.table_writers(str(folder / "out"))),
        str(folder / "checkpoint"),
        once=True,
        **kwargs,
    )
    assert query.awaitTermination(120)


def put(folder, name, *events_):
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / name).write_text("".join(json.dumps(e) + "\n" for e in events_))


def test_stream_routes_and_resumes(spark, tmp_path):
    put(tmp_path, "a.txt", VALID, VALID | {"time_in_seconds": 700}, VALID | {"line": " "})
    put(tmp_path, "b.txt", VALID | {"stop": None})
    start(spark, tmp_path)
    start(spark, tmp_path)  # nothing new
    put(tmp_path, "c.txt", VALID | {"line": "V7"})
    start(spark, tmp_path)

    def table(name):
        return spark.read.parquet(str(tmp_path / "out" / name))

    assert table("arrivals").count() == 3
    assert table("arrivals").where("created_at IS NULL").count() == 0
    assert table("alerts").count() == 1
    assert sorted(r.error_code for r in table("errors").collect()) == [
        "blank_field",
        "missing_field",
    ]
    cycles = table("cycles").groupBy().sum("messages_sent", "messages_rejected", "alerts_sent")
    assert rows(cycles) == [(3, 2, 1)]


def test_numbers_beyond_32_bits_and_bad_times_do_not_stop_the_query(spark, tmp_path):
    put(
        tmp_path,
        "a.txt",
        VALID | {"time_in_seconds": 3_000_000_000},
        VALID | {"timestamp": 1770000123000000000},
        VALID | {"timestamp": 1770000123000},
        VALID,
    )
    start(spark, tmp_path)
    out = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in ("arrivals", "alerts", "errors", "cycles")}
    assert {n: df.count() for n, df in out.items()} == {"arrivals": 2, "alerts": 1, "errors": 2, "cycles": 1}
    assert out["cycles"].first().alerts_sent == 1
    assert out["alerts"].first().time_in_seconds == 3_000_000_000
    assert out["arrivals"].select("event_date").distinct().count() == 1


def test_times_without_checks_become_null(messages):
    df = events.clean_arrivals(events.parse_messages(messages(VALID | {"timestamp": 1770000123000000000})))
    assert df.first().event_timestamp is None


def test_two_queries_share_a_table(spark, tmp_path):
    """Both start at batch 0; neither replaces the other's rows, nor does a new checkpoint."""
    for name in ("one", "two"):
        folder = tmp_path / name
        folder.mkdir()
        put(folder, "a.txt", VALID, VALID | {"line": ""})
        for checkpoint in ("c1", "c2"):
            query = jobs.start(
                jobs.text_source(spark, str(folder / "in")),
                jobs.fan_out(jobs.table_writers(str(tmp_path / "out"))),
                str(folder / checkpoint),
                once=True,
            )
            assert query.awaitTermination(120)
    for name in ("arrivals", "errors", "cycles"):
        df = spark.read.parquet(str(tmp_path / "out" / name))
        assert df.count() == 4 and df.select("query_id").distinct().count() == 4


def test_replayed_batch_replaces_itself(spark, frame, tmp_path):
    write = jobs.parquet_writer(str(tmp_path / "t"))
    df = frame("a INT", (1,), (2,))
    for batch in (0, 1, 1, 0):
        write(df, batch)
    write(df.limit(0), 2)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_jdbc_writer_skips_empty_batches(frame, monkeypatch):
    calls = []
    monkeypatch.setattr(jobs, "append_jdbc", lambda df, *a, **k: calls.append((df.count(), a, k)))
    write = jobs.jdbc_writer("jdbc:x", "realtime_bus_arrivals", user="u")
    write(frame("a INT", (1,), (2,)), 0)
    write(frame("a INT", (1,)).limit(0), 1)
    assert calls == [(2, ("jdbc:x", "realtime_bus_arrivals"), {"user": "u"})]


def test_topics(messages):
    out = jobs.topics(
        events.check_messages(messages(VALID, VALID | {"time_in_seconds": 601}, "junk"))
    )
    assert {name: df.count() for name, df in out.items()} == {
        "gtfs-realtime": 2,
        "transport-alerts": 1,
        "transport-errors": 1,
    }
    assert all(df.columns == ["value"] for df in out.values())


def test_messages_are_parsed_once(messages):
    """Filters read the parsed columns and do not repeat the parsing."""
    plan = events.alerts(
        events.parse_messages(events.valid(events.check_messages(messages(VALID))))
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("parseJson") == 1
