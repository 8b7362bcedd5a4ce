import datetime as dt

import pytest
from conftest import rows

from checks import views
from tramline.functions.snapshots import ALL, at_snapshot
from tramline.operators import dimensional, quality
from tramline.plans import cards, relational, star, warehouse
from tramline.sources import tables

SF = "/root/testdata/sf0.001"
JAN, FEB = dt.date(2026, 1, 1), dt.date(2026, 2, 1)


def snapshot(frame, date, routes=("R1", "R2"), trips=(("T1", "R1", "C1"), ("T2", "R2", "D1"))):
    def stamped(schema, *data):
        return frame(f"{schema}, snapshot_date DATE", *((*r, date) for r in data))

    route = "route_id STRING, route_short_name STRING, route_long_name STRING, route_type INT, " \
        "route_url STRING, route_color STRING, route_text_color STRING"
    stop = "stop_id STRING, stop_code STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE, " \
        "stop_url STRING, location_type INT, parent_station STRING, wheelchair_boarding INT"
    days = "monday INT, tuesday INT, wednesday INT, thursday INT, friday INT, saturday INT, sunday INT"
    return {
        "routes": stamped(route, *((r, r.lower(), f"{r} {date}", 3, None, None, None) for r in routes)),
        "stops": stamped(stop, ("S1", "1", "Uno", 41.0, 2.0, None, 0, None, 1)),
        "calendar": stamped(
            f"service_id STRING, {days}, start_date DATE, end_date DATE",
            ("C1", 1, 1, 1, 1, 1, 0, None, JAN, FEB),
        ),
        "calendar_dates": stamped(
            "service_id STRING, date DATE, exception_type INT",
            ("D1", JAN, 1), ("D1", FEB, 1), ("C1", JAN, 2), ("Z", JAN, 1),
        ),
        "trips": stamped(
            "trip_id STRING, route_id STRING, service_id STRING, trip_headsign STRING, "
            "direction_id INT, shape_id STRING, wheelchair_accessible INT",
            *((*t, "x", 0, None, None) for t in trips),
        ),
        "stop_times": stamped(
            "trip_id STRING, stop_id STRING, arrival_time STRING, departure_time STRING, "
            "stop_sequence INT",
            *((t[0], "S1", "25:00:00", "25:00:00", 1) for t in trips),
        ),
    }


def keys(spark, root, name):
    key, (natural, *_) = dimensional.KEYS[name]
    df = tables.read_table(spark, f"{root}/{name}")
    return {(r[natural], r["snapshot_date"]): r[key] for r in df.collect()}


def test_reload_keeps_dimension_keys_and_renews_facts(spark, frame, tmp_path):
    root = str(tmp_path)
    assert rows(warehouse.load_star(spark, snapshot(frame, JAN), root)) == [
        ("fact_stop_time", 2),
        ("fact_trip", 2),
    ]
    dims, facts = keys(spark, root, "dim_route"), keys(spark, root, "fact_trip")
    changed = snapshot(frame, JAN, routes=("R1", "R3"), trips=(("T1", "R1", "C1"),))
    changed["routes"] = changed["routes"].withColumn(
        "route_long_name", changed["routes"]["route_id"]
    )
    assert rows(warehouse.load_star(spark, changed, root)) == [
        ("fact_stop_time", 1),
        ("fact_trip", 1),
    ]
    after = keys(spark, root, "dim_route")
    assert {k: after[k] for k in dims} == dims  # R2 left the feed and is kept
    assert len(set(after.values())) == 3
    names = {
        r.route_id: r.route_long_name
        for r in tables.read_table(spark, f"{root}/dim_route").collect()
    }
    assert names == {"R1": "R1", "R2": f"R2 {JAN}", "R3": "R3"}
    assert not set(keys(spark, root, "fact_trip").values()) & set(facts.values())


def test_second_snapshot_leaves_the_first_alone(spark, frame, tmp_path):
    root = str(tmp_path)
    warehouse.load_star(spark, snapshot(frame, JAN), root)
    first = keys(spark, root, "fact_trip")
    both = {
        n: df.unionByName(snapshot(frame, FEB)[n]) for n, df in snapshot(frame, JAN).items()
    }
    warehouse.load_star(spark, both, root)  # the newest snapshot only
    second = keys(spark, root, "fact_trip")
    assert {k: v for k, v in second.items() if k[1] == JAN} == first
    assert len(set(second.values())) == 4
    full = warehouse.open_star(spark, root)
    assert rows(cards.total_trips(full)) == [(2,)]
    assert rows(star.table_totals(full)) == [(4, 2, 4, 4, 4)]
    assert not [r for r in quality.key_audit(full).collect() if r.violations]


def test_trips_without_route_or_service_vanish(spark, frame, tmp_path):
    data = snapshot(
        frame, JAN, trips=(("T1", "R1", "C1"), ("T2", "R9", "C1"), ("T3", "R1", "C9"))
    )
    assert rows(warehouse.load_star(spark, data, str(tmp_path))) == [
        ("fact_stop_time", 1),
        ("fact_trip", 1),
    ]


def test_duplicate_natural_keys_stop_the_load(spark, frame, tmp_path):
    data = snapshot(frame, JAN, routes=("R1", "R1"))
    with pytest.raises(quality.QualityError, match="unique_key: routes"):
        warehouse.load_star(spark, data, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_a_reload_without_facts_removes_the_old_ones(spark, frame, tmp_path):
    root = str(tmp_path)
    warehouse.load_star(spark, snapshot(frame, JAN), root)
    both = {n: df.unionByName(snapshot(frame, FEB)[n]) for n, df in snapshot(frame, JAN).items()}
    warehouse.load_star(spark, both, root)
    orphans = snapshot(frame, FEB, trips=(("T1", "nowhere", "C1"),))
    assert rows(warehouse.load_star(spark, orphans, root)) == [("fact_stop_time", 0), ("fact_trip", 0)]
    full = warehouse.open_star(spark, root)
    assert full["fact_trip"].count() == 2 == full["fact_stop_time"].count()
    assert full.newest["fact_trip"] == JAN and full.newest["dim_route"] == FEB
    assert rows(cards.total_trips(full)) == [(2,)]


def test_a_failed_load_leaves_the_star_as_it_was(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path)
    warehouse.load_star(spark, snapshot(frame, JAN), root)
    before = {n: rows(df) for n, df in warehouse.open_star(spark, root).items()}
    changed = snapshot(frame, JAN, routes=("R1", "R3"), trips=(("T1", "R1", "C1"),))

    def fail(*_):
        raise OSError("disk")

    with monkeypatch.context() as patched:
        patched.setattr(dimensional, "stop_time_facts", fail)  # dimensions and trips are staged
        with pytest.raises(OSError):
            warehouse.load_star(spark, changed, root)
    assert {n: rows(df) for n, df in warehouse.open_star(spark, root).items()} == before
    warehouse.load_star(spark, changed, root)
    assert warehouse.open_star(spark, root)["fact_trip"].count() == 1


def test_an_empty_snapshot_replaces_the_old_one(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("a INT, snapshot_date DATE", (1, JAN), (2, FEB))
    tables.replace_snapshots(df, path)
    tables.replace_snapshots(df.limit(0), path, snapshot=FEB)
    assert rows(tables.read_table(spark, path)) == [(1, JAN)]
    tables.replace_snapshots(df.limit(0), path, snapshot=str(JAN))
    assert rows(tables.read_table(spark, path)) == []
    tables.replace_snapshots(df, path)
    tables.replace_snapshots(df.where("a = 1"), path, snapshot=ALL)
    assert rows(tables.read_table(spark, path)) == [(1, JAN)]


def test_no_trips_is_an_error(spark, frame, tmp_path):
    data = snapshot(frame, JAN)
    data["trips"] = data["trips"].limit(0)
    with pytest.raises(RuntimeError, match="no trips"):
        warehouse.load_star(spark, data, str(tmp_path))


def test_weekday_flags(spark, frame, tmp_path):
    warehouse.load_star(spark, snapshot(frame, JAN), str(tmp_path))
    full = warehouse.open_star(spark, str(tmp_path))
    assert [tuple(r) for r in star.trips_by_weekday(full).collect()] == [
        ("Lunes", 1),
        ("Martes", 1),
        ("Miércoles", 1),
        ("Jueves", 1),
        ("Viernes", 1),
        ("Sábado", 0),
        ("Domingo", 0),
    ]
    assert rows(star.service_active_days(full).select("service_id", "dias_activos")) == [
        ("C1", 5),
        ("D1", 0),
    ]


PLANS = (
    relational.top_routes_by_trips,
    relational.trips_by_transport,
    relational.top_stops_by_calls,
    relational.top_routes_by_stops,
    relational.trips_by_direction,
    relational.calendar_exceptions,
    relational.top_services,
)


@pytest.mark.parametrize("plan", PLANS)
def test_relational_queries_default_to_the_newest_snapshot(spark, plan):
    by_default = rows(plan(views.history(spark, SF)))
    assert by_default == rows(plan(views.newest(spark, SF), ALL))
    assert by_default == rows(plan(views.history(spark, SF), "2001-01-01"))
    if plan is not relational.calendar_exceptions:  # the same in every snapshot
        assert by_default != rows(plan(views.history(spark, SF), "1999-01-01"))


def test_snapshot_filter_prunes_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("a INT, snapshot_date DATE", (1, JAN), (2, FEB))
    tables.replace_snapshots(df, path)
    newest = at_snapshot(tables.read_table(spark, path))
    assert [r.a for r in newest.collect()] == [2]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_equal_names_share_their_stops(spark, frame, tmp_path):
    """Two routes of one name: grouped by name, not by id."""
    data = snapshot(frame, JAN, trips=(("T1", "R1", "C1"), ("T2", "R2", "C1")))
    data["routes"] = data["routes"].replace({"r1": "r", "r2": "r"}, subset=["route_short_name"])
    data["routes"] = data["routes"].withColumn("route_long_name", data["routes"]["route_short_name"])
    warehouse.load_star(spark, data, str(tmp_path))
    full = warehouse.open_star(spark, str(tmp_path))
    assert rows(star.top_route_names_by_stops(full)) == [("r", "r", 1)]
    assert rows(star.route_workload(full)) == [("r", "r", 2, 2)]
    assert rows(star.top_routes(full).select("num_viajes")) == [(1,), (1,)]
    assert rows(star.model_totals(full)) == [(2, 2, 1, 1, 2)]
