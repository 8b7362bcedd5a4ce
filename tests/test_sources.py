import datetime as dt
import os

import pytest
from conftest import rows

from tramline import schemas
from tramline.operators import clean, quality
from tramline.plans.batch import run_batch, run_text_batch, stage_feed
from tramline.session import scratch_dir
from tramline.sources import feed, listing, tables

FILES = {
    "agency": "agency_name,agency_url,agency_timezone,agency_lang,agency_phone\nA,u,Europe/Madrid,ca,1\n",
    "routes": "route_color,route_id,route_short_name,route_long_name,route_type,route_url,"
    "route_text_color,extra\nFF,0001,NA,One,3,,00,x\nFF,0002,L1, Two ,1,,00,x\n",
    "trips": "route_id,service_id,trip_id,trip_headsign,direction_id,shape_id,"
    "wheelchair_accessible\n0001,C1,T1,Centre,0,s,1\n0002,D1,T2,Port,1,s,\n",
    "stops": "stop_id,stop_code,stop_name,stop_lat,stop_lon,stop_url,location_type,"
    "parent_station,wheelchair_boarding\nS1,0012,Uno,41.38,2.17,,0,,1\nS2,2,Dos,41.39,2.18,,0,,\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
    "T1,08:00:00,08:00:00,S1,1\nT1,25:10:00,25:10:00,S2,2\nT2,,,S1,1\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,"
    "start_date,end_date\nC1,1,1,1,1,1,0,0,20260101,20261231\n",
    "calendar_dates": "service_id,date,exception_type\nD1,20260914,1\nZ9,20260914,1\n",
}


def write_feed(root, date="2026-01-05", **changes):
    folder = root / date / "extracted"
    folder.mkdir(parents=True)
    for name, text in (FILES | changes).items():
        if text is not None:
            (folder / f"{name}.txt").write_text(text)
    return str(folder)


def test_typed_feed_by_header_name(spark, tmp_path):
    data = feed.read_feed(spark, write_feed(tmp_path))
    assert {d: df.columns for d, df in data.items()} == {
        d: schemas.feed_schema(d).fieldNames() for d in schemas.DATASETS
    }
    assert [r.route_id for r in data["routes"].orderBy("route_id").collect()] == ["0001", "0002"]
    assert data["routes"].dtypes[3] == ("route_type", "int")
    assert "25:10:00" in [r.arrival_time for r in data["stop_times"].collect()]
    assert data["stops"].where("stop_code = '0012'").count() == 1


def test_text_feed_keeps_tokens_and_nulls_blanks(spark, tmp_path):
    data = feed.read_text_feed(spark, write_feed(tmp_path))
    assert set(data) == set(schemas.TEXT_DATASETS)
    kinds = {c: t for df in data.values() for c, t in df.dtypes}
    assert kinds.pop(feed.SOURCE_ROW).startswith("struct")  # the position of a stop
    assert set(kinds.values()) == {"string"}
    names = {r.route_id: r.route_short_name for r in data["routes"].collect()}
    assert names["0001"] == "NA"
    assert data["stop_times"].where("arrival_time IS NULL").count() == 1


def test_optional_file_may_be_missing(spark, tmp_path):
    data = feed.read_feed(spark, write_feed(tmp_path, calendar_dates=None))
    assert data["calendar_dates"].count() == 0
    assert data["calendar_dates"].columns == ["service_id", "date", "exception_type"]


def test_doubled_quotes_are_one(spark, tmp_path):
    stops = FILES["stops"].replace("Uno", '"Pl. ""Nova"" 3, b"')
    data = feed.read_text_feed(spark, write_feed(tmp_path, stops=stops), ["stops"])
    assert 'Pl. "Nova" 3, b' in [r.stop_name for r in data["stops"].collect()]


def test_the_first_row_of_a_stop_wins(spark, tmp_path):
    rows_ = FILES["stops"] + "S1,9,Zeta,41.0,2.0,,0,,1\nS1,9,Alfa,41.0,2.0,,0,,1\n"
    text = rows_.replace("S1,0012,Uno", "S1,0012,Zzz")
    data = feed.read_text_feed(spark, write_feed(tmp_path, stops=text), ["routes", "stops"])
    kept = clean.clean_text_feed(data)["stops"]
    assert {r.stop_id: r.stop_name for r in kept.collect()}["S1"] == "Zzz"


def test_a_batch_without_the_optional_file(spark, tmp_path):
    write_feed(
        tmp_path / "raw",
        calendar_dates=None,
        trips=FILES["trips"].replace("D1", "C1"),
    )
    report = run_batch(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), str(tmp_path / "wh"))
    assert rows(report) == [("fact_stop_time", 3), ("fact_trip", 2)]


def test_text_batch(spark, tmp_path):
    write_feed(tmp_path / "raw", stops=FILES["stops"] + "S1,0012,Again,41.38,2.17,,0,,1\n")
    for _ in range(2):  # the same output again
        report = run_text_batch(spark, str(tmp_path / "raw"), str(tmp_path / "csv"))
    by_name = {r.dataset: r for r in report.collect()}
    assert by_name["stops"].rows == 2 and by_name["stops"].duplicate_stop_ids == 0
    assert by_name["stop_times"].rows == 3 and by_name["stop_times"].duplicates == 0
    stops = spark.read.option("header", True).csv(str(tmp_path / "csv" / "2026-01-05" / "stops.csv"))
    assert sorted(r.stop_name for r in stops.collect()) == ["Dos", "Uno"]


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(feed.FeedError, match="exception_type"):
        feed.read_feed(spark, write_feed(tmp_path, calendar_dates="service_id,date\nC1,20260914\n"))


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"trips": None}, "required_file: trips.trips.txt"),
        ({"stops": FILES["stops"].replace("stop_lat", "lat")}, "required_column: stops.stop_lat"),
        ({"agency": ""}, "required_file: agency"),  # an empty file holds no header either
        ({"calendar": FILES["calendar"].splitlines()[0] + "\n"}, "no_records: calendar"),
    ],
)
def test_raw_checks(spark, tmp_path, changes, message):
    with pytest.raises(quality.QualityError, match=message):
        stage_feed(spark, write_feed(tmp_path, **changes))


def test_header_only_file_has_its_columns(spark, tmp_path):
    header = FILES["calendar"].splitlines()[0] + "\n"
    df = feed.read_text(spark, write_feed(tmp_path, calendar=header), "calendar")
    assert df.columns == schemas.RAW_REQUIRED["calendar"] and df.isEmpty()


def test_newest_raw_snapshot(spark, tmp_path):
    write_feed(tmp_path, "2025-12-29")
    newest = write_feed(tmp_path, "2026-01-05")
    (tmp_path / "2026-02-01").mkdir()
    (tmp_path / "2026-02-01" / "gtfs.zip").write_text("x")
    (tmp_path / "notes" / "extracted").mkdir(parents=True)
    (tmp_path / "notes" / "extracted" / "a.txt").write_text("x")
    date, folder = listing.latest_raw_snapshot(spark, str(tmp_path))
    assert date == dt.date(2026, 1, 5) and folder.endswith(newest)


def test_other_files_in_the_folder_do_not_matter(spark, tmp_path):
    folder = write_feed(tmp_path)
    (tmp_path / "2026-01-05" / "extracted" / "readme.md").write_text("x")
    assert feed.discovered_files(spark, folder) == {f"{d}.txt" for d in schemas.DATASETS}


def test_scratch_folder_is_shared_on_a_cluster():
    class Session:
        def __init__(self, master, folder):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = type("Context", (), {"master": master})

    assert scratch_dir(Session("yarn", "hdfs:///tmp/"), "x").startswith("hdfs:///tmp/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn", None), "x")
    assert scratch_dir(Session("local[2]", None), "x")


def test_no_snapshot_is_an_error(spark, tmp_path):
    for chooser in (listing.latest_raw_snapshot, listing.latest_processed_snapshot):
        with pytest.raises(listing.SnapshotNotFound):
            chooser(spark, str(tmp_path))
        with pytest.raises(listing.SnapshotNotFound):
            chooser(spark, str(tmp_path / "nowhere"))


def test_processed_snapshots(spark, frame, tmp_path):
    for day in ("2025-12-31", "2026-01-02", "2026-01-10"):
        tables.write_processed({"agency": frame("agency_name STRING", (day,))}, str(tmp_path), day)
    date, folder = listing.latest_processed_snapshot(spark, str(tmp_path))
    assert date == dt.date(2026, 1, 10)
    assert folder.endswith("year=2026/month=01/day=10")
    assert rows(tables.read_processed(spark, folder, ("agency",))["agency"]) == [("2026-01-10",)]


def test_processed_must_exist_and_have_rows(spark, frame, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_processed(spark, str(tmp_path), ("agency",))
    frame("a STRING", ("x",)).limit(0).write.parquet(str(tmp_path / "agency"))
    with pytest.raises(ValueError, match="no rows"):
        tables.read_processed(spark, str(tmp_path), ("agency",))


def test_lake_paths():
    assert tables.lake_path("s3a://lake/", "raw", "city", "2026-01-05", "a/feed.zip") == (
        "s3a://lake/raw/city/year=2026/month=01/day=05/a/feed.zip"
    )
    with pytest.raises(ValueError):
        tables.day_path("x", "2026-1-5")


def test_replace_touches_one_snapshot(spark, frame, tmp_path):
    path = str(tmp_path / "trips")
    schema = "trip_id STRING, snapshot_date DATE"
    old, new = dt.date(2026, 1, 1), dt.date(2026, 2, 1)
    tables.replace_snapshots(frame(schema, ("a", old), ("b", new)), path, balance=True)
    for _ in range(2):
        tables.replace_snapshots(frame(schema, ("c", new), ("d", new)), path)
    assert rows(tables.read_table(spark, path)) == [("a", old), ("c", new), ("d", new)]


def test_csv_export_overwrites(spark, frame, tmp_path):
    df = frame("a STRING, b STRING", ('x "y", z', None))
    for _ in range(2):
        tables.write_csv({"agency": df}, str(tmp_path), dt.date(2026, 1, 5))
    back = spark.read.option("header", True).option("escape", '"').csv(
        str(tmp_path / "2026-01-05" / "agency.csv")
    )
    assert rows(back) == [('x "y", z', None)]


def test_batch_end_to_end_and_again(spark, tmp_path):
    write_feed(tmp_path / "raw")
    args = [str(tmp_path / d) for d in ("raw", "lake", "warehouse")]
    for _ in range(2):
        assert rows(run_batch(spark, *args)) == [("fact_stop_time", 3), ("fact_trip", 2)]
    services = tables.read_table(spark, str(tmp_path / "warehouse/star/dim_service"))
    # D1 is known by its exception date only but a trip uses it; nothing uses Z9.
    assert sorted(r.service_id for r in services.collect()) == ["C1", "D1"]
    stored = tables.read_table(spark, str(tmp_path / "warehouse/relational/trips"))
    assert rows(quality.history(stored)) == [(dt.date(2026, 1, 5), 2)]
    assert os.path.isdir(tmp_path / "lake/year=2026/month=01/day=05/stops")


def test_batch_stops_at_a_violation(spark, tmp_path):
    orphan = FILES["trips"] + "0009,C1,T3,X,0,s,1\n"
    write_feed(tmp_path / "raw", trips=orphan)
    with pytest.raises(quality.QualityError, match="missing_reference: trips.route_id"):
        run_batch(spark, *(str(tmp_path / d) for d in ("raw", "lake", "warehouse")))
    assert not (tmp_path / "lake").exists()
