import datetime as dt

import pytest
from conftest import rows

from tramline import schemas
from tramline.operators import clean
from tramline.sources.feed import SOURCE_ROW


def test_routes_keep_ids_and_trim_names(frame):
    row = ("  0x7", "N9 ", "  Harbour line", "7")
    df = frame(
        "route_id STRING, route_short_name STRING, route_long_name STRING, route_type STRING",
        row,
        row,
    )
    assert rows(clean.clean_routes(df)) == [("  0x7", "N9", "Harbour line", 7)]


def test_trips(frame):
    df = frame(
        "trip_id STRING, route_id STRING, service_id STRING, trip_headsign STRING, "
        "direction_id STRING",
        ("a-1 ", " 0x7", "wk ", "  Old port", "0"),
    )
    assert rows(clean.clean_trips(df)) == [("a-1 ", " 0x7", "wk ", "Old port", 0)]


def test_stops_without_coordinates_go(frame):
    df = frame(
        "stop_id STRING, stop_code STRING, stop_name STRING, stop_lat STRING, stop_lon STRING",
        ("S1", "0012", " Uno ", "41.38", "2.17"),
        ("S2", "2", "Dos", None, "2.17"),
        ("S3", "3", "Tres", "north", "2.17"),
        (None, "4", "Cuatro", "41.38", "2.17"),
    )
    assert rows(clean.clean_stops(df)) == [("S1", "0012", "Uno", 41.38, 2.17)]


def test_stop_times(frame):
    df = frame(
        "trip_id STRING, stop_id STRING, stop_sequence STRING, arrival_time STRING, "
        "departure_time STRING",
        ("T1", "S1", "1", " 25:10:00 ", " 25:11:00 "),
        (None, "S1", "2", "08:00:00", "08:01:00"),
    )
    assert rows(clean.clean_stop_times(df)) == [("T1", "S1", 1, "25:10:00", "25:11:00")]


def test_calendar_and_exceptions(frame):
    df = frame(
        "service_id STRING, start_date STRING, end_date STRING",
        ("wk", "20250301", "20250630"),
        ("we", "soon", "20250630"),
    )
    assert rows(clean.clean_calendar(df)) == [
        ("we", None, dt.date(2025, 6, 30)),
        ("wk", dt.date(2025, 3, 1), dt.date(2025, 6, 30)),
    ]
    dates = frame(
        "service_id STRING, date INT, exception_type STRING", ("wk", 20250417, "1")
    )
    assert rows(clean.clean_calendar_dates(dates)) == [("wk", dt.date(2025, 4, 17), 1)]


@pytest.fixture
def feed(frame):
    return {
        "agency": frame("agency_name STRING", (" Agency ",)),
        "routes": frame(
            "` route_id ` STRING, `route_short_name\t` STRING", (" R1 ", " 1\t"), ("R2", "   ")
        ),
        "trips": frame("trip_id STRING, route_id STRING", ("T1", "R1"), (None, "R2")),
        "stops": frame(
            f"stop_id STRING, stop_name STRING, stop_lat STRING, stop_lon STRING, {SOURCE_ROW} INT",
            ("S2", "Other", "41.4", "2.2", 3),
            (" S1 ", " Stop 1 ", " 41.39 ", "2.17", 1),
            ("S2", "Stop 2", "41.40", "2.18", 2),
            ("S3", "Stop 3", "invalid", "2.18", 4),
            ("S3", "Stop 3 again", "41.1", "2.18", 5),
        ),
        "stop_times": frame(
            "trip_id STRING, stop_id STRING, stop_sequence STRING",
            ("T1", "S1", "1"),
            ("T1", "S1", "1 "),
            ("T1", "S2", "invalid"),
            ("T1", "", "3"),
        ),
        "calendar": frame("service_id STRING, monday STRING", ("C1", "1"), (" ", "1")),
    }


def test_text_rules(feed):
    out = clean.clean_text_feed(feed)
    assert out["routes"].columns == ["route_id", "route_short_name"]
    assert rows(out["routes"]) == [("R1", "1"), ("R2", None)]
    assert rows(out["trips"]) == [("T1", "R1")]
    # S3's first row has no valid latitude, so the stop goes although a later one has.
    assert rows(out["stops"]) == [
        ("S1", "Stop 1", 41.39, 2.17),
        ("S2", "Stop 2", 41.40, 2.18),
    ]
    # A sequence that does not parse keeps its row; copies are found after stripping.
    assert rows(out["stop_times"]) == [("T1", "S1", 1), ("T1", "S2", None)]
    assert rows(out["calendar"]) == [("C1", "1")]
    assert rows(out["agency"]) == [("Agency",)]


def test_inputs_stay_as_they_are(feed):
    before = {name: (df.columns, rows(df)) for name, df in feed.items()}
    clean.clean_text_feed(feed)
    assert {name: (df.columns, rows(df)) for name, df in feed.items()} == before


def test_keep_first_folds_a_hot_key_before_the_shuffle(spark, frame):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS k", "id AS o", "id AS v")
    kept = clean.keep_first(df, ["k"], "o")
    assert kept.where("k = 'hot'").collect()[0]["v"] == 0
    assert kept.count() == df.select("k").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_space_trim_differs_from_strip(frame):
    df = frame("route_id STRING, route_short_name STRING, route_long_name STRING, route_type INT",
               ("1", "\tL1 ", "x", 1))
    assert clean.clean_routes(df).first()["route_short_name"] == "\tL1"
    assert clean.normalise_text(df).first()["route_short_name"] == "L1"


def test_every_dataset_has_a_cleaner():
    assert set(clean.CLEANERS) == set(schemas.DATASETS)


def test_copies_are_not_gathered_where_they_are_read(spark):
    """Rows are dealt out before copies go: nothing is combined, held or spilled below the only shuffle."""
    calls = "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence string"
    rows = [("t", " 1", "2 ", "s", "3"), ("t", " 1", "2 ", "s", "3"), ("t", " 1", "2 ", "s", "x"), (None, "1", "2", "s", "3")]
    out = clean.clean_stop_times(spark.createDataFrame(rows, calls))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Repartition" if "Repartition" in plan else "Exchange"):]
    assert sorted(map(tuple, out.collect()), key=str) == [("t", "1", "2", "s", 3), ("t", "1", "2", "s", None)]
