import pytest
from conftest import rows

from tramline.sources import versions
from tramline.sources.listing import list_files
from tramline.streaming import compaction, jobs


def batch(frame, *days):
    """Arrivals ``(id, day)``; created_at and event_date are added when they are stored."""
    df = frame("id INT, day STRING", *days)
    return df.selectExpr("id", "CAST(day || ' 10:00:00' AS TIMESTAMP) AS event_timestamp")


def seen(spark, path, root):
    return sorted(r["id"] for r in compaction.read_arrivals(spark, path, root).collect())


@pytest.fixture
def store(spark, frame, tmp_path):
    path, root = str(tmp_path / "open"), str(tmp_path / "closed")
    write = jobs.arrivals_writer(path)
    for b in range(6):
        write(batch(frame, (b, "2026-01-01"), (10 + b, "2026-01-02")), b)
    return path, root, write


def test_closed_days_become_few_files_and_readers_see_every_row_once(spark, frame, store):
    path, root, write = store
    everything = [*range(6), *range(10, 16)]
    assert seen(spark, path, root) == everything
    assert compaction.compact(spark, path, root, "2026-01-02") == ["2026-01-01"]
    assert seen(spark, path, root) == everything  # the old folders are still there
    assert compaction.compact(spark, path, root, "2026-01-02") == []
    assert compaction.sweep(spark, path, root) == 6
    assert seen(spark, path, root) == everything
    assert list_files(spark, root, "*.parquet").count() == 1
    assert compaction.sweep(spark, path, root) == 0
    again = compaction.read_arrivals(spark, path, root)
    assert dict(again.dtypes) == dict(spark.read.parquet(path).dtypes) | {"batch_id": "bigint"}


def test_a_replay_of_a_merged_batch_is_refused(spark, frame, store):
    path, root, write = store
    compaction.compact(spark, path, root, "2026-01-02")
    compaction.sweep(spark, path, root)
    before = seen(spark, path, root)
    write(batch(frame, (5, "2026-01-01"), (15, "2026-01-02")), 5)
    assert seen(spark, path, root) == before
    assert compaction.compact(spark, path, root, "2026-01-02") == []
    assert compaction.sweep(spark, path, root) == 1
    assert seen(spark, path, root) == before


def test_late_rows_count_and_are_merged_by_the_next_run(spark, frame, store):
    path, root, write = store
    compaction.compact(spark, path, root, "2026-01-02")
    write(batch(frame, (99, "2026-01-01")), 8)
    assert 99 in seen(spark, path, root)
    assert compaction.compact(spark, path, root, "2026-01-02") == ["2026-01-01"]
    assert seen(spark, path, root) == [*range(6), *range(10, 16), 99]
    notes = versions.find(spark, root).notes[compaction.TABLE]
    assert notes == {"2026-01-01": {jobs.DIRECT: [[0, 5], [8, 8]]}}


def test_a_run_that_ends_before_its_commit_changes_nothing(spark, frame, store, monkeypatch):
    path, root, write = store

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(versions, "_rename_new", stop)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, path, root, "2026-01-03")
    monkeypatch.undo()
    assert seen(spark, path, root) == [*range(6), *range(10, 16)]
    assert compaction.compact(spark, path, root, "2026-01-03") == ["2026-01-01", "2026-01-02"]
    compaction.sweep(spark, path, root)
    assert seen(spark, path, root) == [*range(6), *range(10, 16)]  # nothing is left in the open folder


def test_rows_without_a_day_stay(spark, frame, store):
    path, root, write = store
    write(frame("id INT, event_timestamp TIMESTAMP", (77, None)), 9)
    compaction.compact(spark, path, root, "9999-12-31")
    compaction.sweep(spark, path, root)
    assert 77 in seen(spark, path, root) and len(seen(spark, path, root)) == 13


def test_runs():
    assert compaction.runs({3, 1, 2, 7}) == [[1, 3], [7, 7]]
    assert compaction._join([[0, 2], [8, 9]], [[3, 4], [9, 12]]) == [[0, 4], [8, 12]]
