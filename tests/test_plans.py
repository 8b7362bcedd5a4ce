"""Plans hold what the queries promise: pushdown, pruning, top-k, split hot keys."""

import re

import pytest

import __spark_entry__ as entry
from checks import views
from tramline.functions import snapshots
from tramline.functions.aggregates import missing_keys, surplus_rows
from tramline.functions.snapshots import ALL
from tramline.operators import dimensional
from tramline.plans import realtime, relational, star, warehouse

SF = "/root/testdata/sf0.001"


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["a01_top_routes", "a03_top_stops", "d01_top_routes", "b06_top_stops"])
def test_top_k_never_sorts_everything(spark, name):
    assert "TakeOrderedAndProject" in physical_plan(entry.queries()[name](spark, SF))


def test_scans_read_only_what_they_need(spark):
    plan = physical_plan(relational.top_services(views.newest(spark, SF), ALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\), GreaterThanOrEqual\(o_orderdate", plan)


def test_last_hour_is_pushed_into_the_scan(spark):
    plan = physical_plan(entry.queries()["r01_arrivals_per_line"](spark, SF))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_cards_prune_partitions(spark):
    plan = physical_plan(entry.queries()["b03_total_trips"](spark, SF))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


@pytest.mark.parametrize("name", ["a01_top_routes", "a03_top_stops", "a06_calendar_exceptions", "b06_top_stops", "r06_newest_snapshot"])
def test_the_newest_snapshot_is_named_not_looked_for(spark, name):
    """Every scan of a history table has the date as a partition filter."""
    names = [n for n in entry.queries() if n.startswith(name[:4])]
    plan = physical_plan(entry.queries()[names[0]](spark, SF))
    scans = re.findall(r"FileScan parquet .*?PartitionFilters: \[(.*?)\]", plan)
    assert scans and all("snapshot_date" in s and "ubquery" not in s for s in scans)


def test_a_load_reads_no_stored_facts(spark, tmp_path):
    """Keys go on from the control table; only one partition of the dimensions is read."""
    data = views.history(spark, SF)
    dates = sorted(r.snapshot_date for r in data["trips"].select("snapshot_date").distinct().collect())
    for date in dates[-2:]:
        warehouse.load_star(spark, data, str(tmp_path), date)
    assert warehouse.highest_keys(spark, str(tmp_path))["fact_trip"] > 0
    star = warehouse.open_star(spark, str(tmp_path))
    for name, table in star.items():
        key = dimensional.KEYS[name][0]
        assert table.count() == table.select(key).distinct().count()
    assert star.newest["fact_trip"] == dates[-1]


def test_latest_arrivals_read_the_newest_days(spark, frame, tmp_path):
    rows = [(f"2026-01-{d:02d}", d * 100 + i) for d in range(1, 9) for i in range(d)]
    df = frame("day STRING, n INT", *rows).selectExpr(
        "CAST(day AS DATE) AS event_date", "timestamp_seconds(unix_timestamp(CAST(day AS DATE)) + n) AS event_timestamp",
        "'a' AS line", "'b' AS stop_id", "'c' AS route_id", "n AS arrival_seconds",
    )
    df.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    found = realtime.latest_arrivals(spark.read.parquet(str(tmp_path / "t")), 12)
    assert [r.arrival_seconds for r in found.collect()] == [n for _, n in sorted(rows, key=lambda r: -r[1])][:12]
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date.*?\), \(event_date.*? >= Subquery", physical_plan(found))


def test_hot_stop_is_split_in_a_sort_merge_join(spark):
    """A stop that holds a third of all calls, with sides too large to broadcast."""
    calls = spark.range(0, 60_000, 1, 8).selectExpr(
        "string(id % 5000) AS trip_id",
        "if(id % 3 = 0, 'hot', string(id % 997)) AS stop_id",
        "repeat(string(id), 20) AS arrival_time",
        "'x' AS departure_time",
        "int(id) AS stop_sequence",
        "DATE'2026-01-01' AS snapshot_date",
    )
    stops = spark.range(997).selectExpr("string(id) AS stop_id", "id AS stop_key")
    stops = stops.union(spark.sql("SELECT 'hot', 997L")).selectExpr(
        "*", "DATE'2026-01-01' AS snapshot_date"
    )
    trips = spark.range(5000).selectExpr(
        "string(id) AS trip_id", "DATE'2026-01-01' AS snapshot_date", "id AS trip_key"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = dimensional.stop_time_facts(calls, trips, stops)
        assert len(facts.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in physical_plan(facts)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_copies_fold_before_the_shuffle(spark, keys):
    """Half a million copies of one row leave the map side as one row per task."""
    df = spark.range(0, 500_000, 1, 4).selectExpr("'x' AS a", "1 AS b")
    counted = surplus_rows(df, keys)
    assert counted.first()["n"] == 499_999
    plan = physical_plan(df.groupBy(*keys).count())
    assert plan.index("HashAggregate") < plan.index("Exchange")


def test_missing_keys_never_pass_through_the_driver(spark):
    """exploding keys over the snapshots is not seen by size estimates, so the parents' keys were broadcast."""
    child = spark.range(50).selectExpr("string(id) AS k", "date_add(DATE'2026-01-01', int(id % 2)) AS d")
    parent = spark.range(40).selectExpr("string(id) AS k", "explode(array(DATE'2026-01-01', DATE'2026-01-02')) AS d")
    gaps = missing_keys(child, parent, ["k", "d"])
    assert sorted(int(r.k) for r in gaps.collect()) == list(range(40, 50))
    plan = physical_plan(missing_keys(child, parent, ["k", "d"]))
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_calls_by_trip_meet_their_trips_where_they_lie(spark):
    """Calls that lie by trip are not shuffled again for their trips, and the date still decides."""
    dates = "explode(array(DATE'2026-01-01', DATE'2026-01-02')) AS snapshot_date"
    calls = spark.range(60).selectExpr(
        "string(id % 10) AS trip_id", "string(id % 7) AS stop_id", "'a' AS arrival_time", "'b' AS departure_time",
        "int(id) AS stop_sequence", "date_add(DATE'2026-01-01', int(id % 3)) AS snapshot_date",
    ).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "trip_id")
    trips = spark.range(9).selectExpr("string(id) AS trip_id", dates).selectExpr(
        "*", "100 * day(snapshot_date) + int(trip_id) AS trip_key"
    )
    stops = spark.range(6).selectExpr("string(id) AS stop_id", dates).selectExpr(
        "*", "1000 * day(snapshot_date) + int(stop_id) AS stop_key"
    )
    facts = dimensional.stop_time_facts(calls, trips, stops, by_trip=True)
    want = [
        (100 * (i % 3 + 1) + i % 10, 1000 * (i % 3 + 1) + i % 7, i) for i in range(60) if i % 3 < 2 and i % 10 < 9 and i % 7 < 6
    ]
    assert sorted((r.trip_key, r.stop_key, r.stop_sequence) for r in facts.collect()) == sorted(want)
    by_stop_first = dimensional.stop_time_facts(calls, trips, stops).collect()
    assert sorted((r.trip_key, r.stop_key, r.stop_sequence) for r in by_stop_first) == sorted(want)
    plan = physical_plan(dimensional.stop_time_facts(calls, trips, stops, by_trip=True))
    plan = plan.split("Initial Plan")[-1]
    assert "Broadcast" not in plan and len(re.findall(r"(?:Exchange )?hashpartitioning\(trip_id#\d+, ", plan)) == 2


def test_few_snapshots_are_written_without_one_more_shuffle(spark, monkeypatch, tmp_path):
    """A load of the whole history gathers rows by snapshot only if there are many."""
    asked = []
    gathered = dimensional.gathered
    monkeypatch.setattr(dimensional, "gathered", lambda df, balance=True: asked.append(balance) or gathered(df, balance))
    data = views.history(spark, SF)
    few = warehouse.load_star(spark, data, str(tmp_path / "few"), ALL).collect()
    assert asked and not any(asked)
    asked.clear()
    monkeypatch.setattr(snapshots, "FEW", 2)
    assert warehouse.load_star(spark, data, str(tmp_path / "many"), ALL).collect() == few
    assert asked and all(asked)


def test_route_names_meet_trips_not_calls(spark, frame):
    """names were joined to every (route, stop) pair, which was then shuffled twice more."""
    routes = frame("route_key BIGINT, route_short_name STRING, route_long_name STRING",
                   (1, "A", None), (2, "A", None), (3, "B", "x"), (4, None, None))
    trips = frame("trip_key BIGINT, route_key BIGINT", (10, 1), (11, 2), (12, 3), (13, 4), (14, 9))
    calls = frame("trip_key BIGINT, stop_key BIGINT", (10, 5), (10, 5), (10, 6), (11, 5), (11, 7), (12, 5), (13, 8), (14, 8), (15, 8))
    found = star.top_route_names_by_stops({"dim_route": routes, "fact_trip": trips, "fact_stop_time": calls})
    assert [tuple(r) for r in found.collect()] == [("A", None, 3), (None, None, 1), ("B", "x", 1)]
    plan = physical_plan(found)
    assert not re.search(r"hashpartitioning\(route_short_name[^)]*stop_key", plan)
