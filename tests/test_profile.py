import pytest
from conftest import rows

from tramline import schemas
from tramline.operators import profile


def trips(frame, **counts):
    return frame(
        "trip_id STRING, route_id STRING",
        *((f"{r}-{i}", r) for r, n in counts.items() for i in range(n)),
    )


def test_histogram_has_equal_bins_with_a_closed_top(frame):
    out = profile.trips_histogram(trips(frame, a=1, b=2, c=11, d=21)).collect()
    # bins of width 1 from 1 to 21: the maximum falls into the last one
    assert [tuple(r) for r in out] == [(1, 1), (2, 1), (11, 1), (20, 1)]


def test_histogram_of_equal_counts(frame):
    assert rows(profile.trips_histogram(trips(frame, a=3, b=3))) == [(11, 2)]


def test_null_keys_are_left_out(frame):
    routes = frame("route_id STRING, route_type INT", ("a", 1), ("b", None), ("c", 1))
    assert rows(profile.routes_per_type(routes)) == [(1, 2)]
    with_null = trips(frame, a=2).union(frame("t STRING, r STRING", ("x", None)))
    assert rows(profile.trips_per_route(with_null)) == [("a", 2)]
    assert rows(profile.trips_per_route_stats(with_null)) == [(2.0, 2, 2)]


def test_null_matches_null_in_reference_gaps(frame):
    tables = {
        "routes": frame("route_id STRING", (None,), ("R1",)),
        "trips": frame("trip_id STRING, route_id STRING", ("T1", None), ("T2", "R2"), ("T3", "R2")),
        "stops": frame("stop_id STRING", ("S1",)),
        "stop_times": frame("trip_id STRING, stop_id STRING", ("T1", None), ("T1", None)),
    }
    assert rows(profile.reference_gaps(tables)) == [
        ("stop_times.stop_id", 1, 2),
        ("stop_times.trip_id", 0, 0),
        ("trips.route_id", 1, 2),
    ]


@pytest.fixture
def network(frame):
    return {
        "routes": frame(
            "route_id STRING, route_short_name STRING, route_type INT",
            ("1", "L1", 1),
            ("1b", "L1", 1),
            ("2", "L2", 1),
            ("9", "X9", 1),
            ("b", "V7", 3),
        ),
        "trips": frame(
            "trip_id STRING, route_id STRING",
            ("t1", "1"),
            ("t1b", "1b"),
            ("t2", "2"),
            ("t9", "9"),
            ("tb", "b"),
        ),
        "stops": frame(
            "stop_id STRING, stop_name STRING, stop_lat STRING, stop_lon STRING",
            ("A", "a", "41", "2"),
            ("B", "b", "41", "2"),
            ("C", "c", "41", "2"),
            ("D", "d", "bad", "2"),
        ),
        "stop_times": frame(
            "trip_id STRING, stop_id STRING",
            ("t1", "A"),
            ("t1", "A"),
            ("t1b", "A"),
            ("t1", "B"),
            ("t2", "B"),
            ("t9", "C"),
            ("t1", "D"),
            ("tb", "C"),
        ),
    }


def test_metro_stops(network):
    out = {
        r.stop_id: (r.route_count, r.routes, r.colors, r.display_color)
        for r in profile.metro_stops(network).collect()
    }
    l1, l2 = schemas.METRO_COLORS["L1"], schemas.METRO_COLORS["L2"]
    assert out == {
        "A": (1, "L1", [l1, l1], l1),  # two routes of one name: one line, two colours
        "B": (2, "L1, L2", sorted([l1, l2]), schemas.SHARED_STOP_COLOR),
        "C": (1, "X9", [schemas.METRO_OTHER], schemas.METRO_OTHER),
    }
    assert rows(profile.network_totals(profile.metro_stops(network))) == [(3, 2, 1)]


def test_bus_stops(network):
    (stop,) = profile.bus_stops(network).collect()
    assert (stop.stop_id, stop.display_color) == ("C", schemas.BUS_PREFIX_COLORS["V"])


def test_route_trip_counts_keep_routes_without_trips(frame):
    tables = {
        "routes": frame("route_id STRING, route_short_name STRING", ("a", "A"), ("z", "Z"), ("z", "Z")),
        "trips": frame("trip_id STRING, route_id STRING", ("1", "a"), ("1", "a"), ("2", "a")),
    }
    assert rows(profile.route_trip_counts(tables)) == [("a", "A", 2), ("z", "Z", 0)]


def test_top_routes_label_falls_back_to_the_id(frame):
    tables = {
        "routes": frame("route_id STRING, route_short_name STRING, route_long_name STRING", ("a", "A", "x")),
        "trips": trips(frame, a=1, q=2),
    }
    assert [r.etiqueta for r in profile.top_routes(tables).collect()] == ["q", "A"]


def test_describe_breaks_ties_by_value(frame):
    df = frame("k STRING, e STRING", ("b", None), ("a", None), (None, None))
    assert rows(profile.describe_text(df)) == [("e", 0, 0, None, None), ("k", 2, 2, "a", 1)]
