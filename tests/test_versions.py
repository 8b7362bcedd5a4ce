import datetime as dt

import pytest
from conftest import rows
from test_warehouse import FEB, JAN, snapshot

from tramline.functions.snapshots import ALL
from tramline.plans import warehouse
from tramline.sources import versions


def content(star):
    return {name: rows(df) for name, df in star.items()}


def whole(star):
    """Every fact has its dimension rows."""
    lost = star["fact_trip"].join(star["dim_route"], "route_key", "left_anti").count()
    return lost + star["fact_stop_time"].join(star["fact_trip"], "trip_key", "left_anti").count() == 0


def test_reader_sees_the_old_or_the_new_star_wherever_a_load_stops(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path / "star")
    warehouse.load_star_version(spark, snapshot(frame, JAN), root)
    old = content(versions.open_version(spark, root))
    again = snapshot(frame, JAN, routes=("R1", "R3"), trips=(("T1", "R1", "C1"),))
    stage, rename = versions.stage, versions._rename_new

    class Stop(Exception):
        pass

    for stop in range(6):  # before each of five tables, and before the commit
        done = []

        def stopping(*args):
            if len(done) == stop:
                raise Stop
            done.append(args)
            seen = versions.open_version(spark, root)
            assert {n: df.count() for n, df in seen.items()} == {n: len(r) for n, r in old.items()}
            return (rename if len(args) == 3 else stage)(*args)

        monkeypatch.setattr(versions, "stage", stopping)
        monkeypatch.setattr(versions, "_rename_new", stopping)
        with pytest.raises(Stop):
            warehouse.load_star_version(spark, again, root)
        assert content(versions.open_version(spark, root)) == old
    monkeypatch.undo()

    opened = versions.open_version(spark, root)
    assert rows(warehouse.load_star_version(spark, again, root)) == [("fact_stop_time", 1), ("fact_trip", 1)]
    assert content(opened) == old  # a reader from before keeps its version
    new = versions.open_version(spark, root)
    assert whole(new) and new["fact_trip"].count() == 1 and new["dim_route"].count() == 3
    kept = {r["route_id"]: r["route_key"] for r in opened["dim_route"].collect()}
    now = {r["route_id"]: r["route_key"] for r in new["dim_route"].collect()}
    assert {k: now[k] for k in kept} == kept and len(set(now.values())) == 3


def test_second_of_two_loads_fails_and_changes_nothing(spark, frame, tmp_path):
    root = str(tmp_path)
    one = frame("a INT, snapshot_date DATE", (1, JAN))
    before = versions.find(spark, root)
    staged = {"t": versions.stage(spark, root, "t", one)}
    versions.write_version(spark, root, {"t": one.selectExpr("a + 1 AS a", "snapshot_date")})
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark, root, before, staged)
    with pytest.raises(versions.VersionConflict):  # the name is taken after the look at the listing
        versions._rename_new(spark, root, versions.Version(1, staged))
    assert rows(versions.open_version(spark, root)["t"]) == [(2, JAN)]
    assert versions.numbers(spark, root) == [1]


def test_snapshots_are_replaced_one_or_all_and_by_nothing(spark, frame, tmp_path):
    root, schema = str(tmp_path), "a INT, snapshot_date DATE"
    versions.write_version(spark, root, {"t": frame(schema, (1, JAN), (2, FEB)), "u": frame(schema, (7, JAN))}, balance=True)
    versions.write_version(spark, root, {"t": frame(schema)}, FEB)
    opened = versions.open_version(spark, root)
    assert rows(opened["t"]) == [(1, JAN)] and rows(opened["u"]) == [(7, JAN)]
    assert opened.newest == {"t": JAN, "u": JAN}
    versions.write_version(spark, root, {"t": frame(schema)}, ALL)
    assert rows(versions.open_version(spark, root)["t"]) == []
    assert versions.open_version(spark, root).newest["t"] is None
    assert rows(versions.open_version(spark, root, number=1)["t"]) == [(1, JAN), (2, FEB)]
    assert rows(versions.open_version(spark, root, snapshot=FEB, number=1)["t"]) == [(2, FEB)]


def test_relational_tables_change_together(spark, frame, tmp_path):
    root = str(tmp_path)
    versions.load_relational(spark, {"r": frame("a INT", (1,)), "s": frame("b STRING", ("x",))}, root, "2026-01-01")
    versions.load_relational(spark, {"r": frame("a INT", (2,)), "s": frame("b STRING")}, root, "2026-01-01")
    opened = versions.open_version(spark, root)
    assert rows(opened["r"]) == [(2, dt.date(2026, 1, 1))] and rows(opened["s"]) == []


def test_expired_versions_go_with_what_only_they_name(spark, frame, tmp_path):
    root, schema = str(tmp_path), "a INT, snapshot_date DATE"
    for a in (1, 2, 3):
        versions.write_version(spark, root, {"t": frame(schema, (a, JAN), *([(0, FEB)] if a == 1 else []))})
    under_way = versions.stage(spark, root, "t", frame(schema, (4, JAN)))
    assert len(versions.expire(spark, root, keep=2)) == 1
    assert versions.numbers(spark, root) == [2, 3]
    assert rows(versions.open_version(spark, root, number=2)["t"]) == [(0, FEB), (2, JAN)]
    versions.publish(spark, root, versions.find(spark, root), {"t": under_way})
    assert rows(versions.open_version(spark, root)["t"]) == [(0, FEB), (4, JAN)]
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)


def test_only_the_folders_of_a_snapshot_are_read(spark, frame, tmp_path):
    root = str(tmp_path)
    versions.write_version(spark, root, {"t": frame("a INT, snapshot_date DATE", (1, JAN), (2, FEB))})
    plan = versions.open_version(spark, root, FEB)["t"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
