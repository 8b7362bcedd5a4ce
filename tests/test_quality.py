import pytest
from conftest import rows

from tramline import schemas
from tramline.operators import quality


@pytest.fixture
def valid(frame):
    """Two lines that share a stop."""
    return {
        "routes": frame("route_id STRING", ("R1",), ("night",)),
        "trips": frame("trip_id STRING, route_id STRING", ("T1", "R1"), ("late", "night")),
        "stops": frame("stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE", ("S1", 40.5, 1.75)),
        "stop_times": frame("trip_id STRING, stop_id STRING", ("T1", "S1"), ("late", "S1")),
        "calendar": frame("service_id STRING", ("wk",), ("we",)),
    }


def failed(report):
    return {(r.rule, r.dataset, r.field): r.violations for r in report.collect() if r.violations}


def test_valid_data_passes_the_gate(valid):
    assert not failed(quality.gate(quality.raw_report(valid)))


@pytest.mark.parametrize(
    "name, schema, bad, rule, field, n",
    [
        ("routes", "route_id STRING", [("R1",), ("night",), (None,)], "null_identifier", "route_id", 1),
        (
            "trips",
            "trip_id STRING, route_id STRING",
            [("T1", "R2"), ("T2", "R2"), ("late", "R1")],
            "missing_reference",
            "route_id",
            1,
        ),
        (
            "stop_times",
            "trip_id STRING, stop_id STRING",
            [("T1", "S1"), ("T1", "S1"), ("T1", "S1")],
            "duplicate_row",
            "*",
            2,
        ),
        (
            "stops",
            "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE",
            [("S1", 95.0, 2.17)],
            "coordinates",
            "out of range",
            1,
        ),
        (
            "stops",
            "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE",
            [("S1", 41.0, None)],
            "coordinates",
            "stop_lon missing",
            1,
        ),
    ],
)
def test_raw_violations(valid, frame, name, schema, bad, rule, field, n):
    report = quality.raw_report(valid | {name: frame(schema, *bad)})
    assert failed(report) == {(rule, name, field): n}
    with pytest.raises(quality.QualityError, match=rule):
        quality.gate(report)


def test_null_reference_counts_once_and_is_no_match(valid, frame):
    trips = frame("trip_id STRING, route_id STRING", ("T1", None), ("T2", None))
    routes = frame("route_id STRING", (None,), ("R1",))
    report = quality.broken_references(valid | {"trips": trips, "routes": routes})
    assert failed(report)[("missing_reference", "trips", "route_id")] == 1


def test_sample_lists_the_first_five(valid, frame):
    trips = frame("trip_id STRING, route_id STRING", *((f"T{i}", f"X{i}") for i in range(9)))
    report = quality.broken_references(valid | {"trips": trips})
    sample = {r.field: r.sample for r in report.collect() if r.dataset == "trips"}
    assert sample == {"route_id": "X0, X1, X2, X3, X4"}


@pytest.fixture
def processed(frame):
    return {
        "agency": frame("agency_name STRING", ("A",)),
        "routes": frame("route_id STRING", ("R1",)),
        "stops": frame("stop_id STRING", ("S1",)),
        "calendar": frame("service_id STRING", ("C1",)),
        "calendar_dates": frame("service_id STRING, date STRING", ("C1", "20260914")),
        "trips": frame("trip_id STRING, route_id STRING, service_id STRING", ("T1", "R1", "C1")),
        "stop_times": frame(
            "trip_id STRING, stop_id STRING, stop_sequence INT", ("T1", "S1", 1)
        ),
    }


def test_processed_snapshot_passes(processed):
    quality.gate(quality.processed_report(processed))
    assert rows(quality.row_counts(processed)) == sorted((d, 1) for d in processed)


def test_processed_snapshot_rejects(processed, frame):
    no_service = processed | {"trips": processed["trips"].drop("service_id")}
    with pytest.raises(quality.QualityError, match="required_column: trips.service_id"):
        quality.gate(quality.processed_report(no_service))

    orphan = processed | {
        "stop_times": frame("trip_id STRING, stop_id STRING, stop_sequence INT", ("T2", "S1", 1))
    }
    with pytest.raises(quality.QualityError, match="stop_times.trip_id has 1 .*T2"):
        quality.gate(quality.processed_report(orphan))

    doubled = processed | {"trips": processed["trips"].union(processed["trips"])}
    with pytest.raises(quality.QualityError, match="duplicate_key: trips.trip_id"):
        quality.gate(quality.processed_report(doubled))

    missing = {n: df for n, df in processed.items() if n != "agency"}
    with pytest.raises(quality.QualityError, match="agency"):
        quality.gate(quality.processed_report(missing))


def test_duplicate_keys_count_null_parts(frame):
    dates = frame("service_id STRING, date STRING", ("C1", None), ("C1", None), (None, None))
    report = quality.duplicate_keys({"calendar_dates": dates})
    assert report.first()["violations"] == 1


def test_missing_files_and_columns(spark):
    report = quality.missing_files(spark, {"agency.txt", "extra.txt", "stops.txt"})
    assert {d for (_, d, _) in failed(report)} == {"routes", "trips", "stop_times", "calendar"}
    columns = {d: list(reversed(c)) + ["extra"] for d, c in schemas.RAW_REQUIRED.items()}
    assert not failed(quality.missing_columns(spark, columns))
    columns["stops"].remove("stop_lat")
    assert list(failed(quality.missing_columns(spark, columns))) == [
        ("required_column", "stops", "stop_lat")
    ]


def test_empty_dataset_is_reported(valid):
    empty = valid | {"calendar": valid["calendar"].limit(0)}
    assert list(failed(quality.empty_datasets(empty))) == [("no_records", "calendar", "*")]


def test_column_audit_finds_long_and_null_values(frame):
    arrivals = frame(
        "event_timestamp TIMESTAMP, destination STRING, line STRING, route_id STRING, "
        "stop_id STRING, arrival_text STRING",
        (None, "x", "L" * 21, "r", "s", "t"),
    )
    report = failed(quality.column_audit({"realtime_bus_arrivals": arrivals}))
    assert {f for (_, _, f) in report} == {"event_timestamp is null", "line longer than 20"}


def test_final_report(frame):
    stops = frame("stop_id STRING, n INT", ("S1", None), ("S1", None), ("S1", 2))
    report = quality.final_report({"stops": stops, "agency": frame("a STRING", ("x",))})
    assert rows(report) == [("agency", 1, 0, 0, None), ("stops", 3, 2, 1, 2)]
