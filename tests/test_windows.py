import pytest

from tramline.streaming import windows

SCHEMA = "line STRING, route_id STRING, stop_id STRING, arrival_seconds BIGINT, event_timestamp TIMESTAMP"


@pytest.fixture
def feed(spark, tmp_path):
    def run(build, mode, *batches):
        for batch in batches:
            frame = spark.createDataFrame([("L", "R", s, w, None) for s, w, _ in batch], SCHEMA)
            times = {s + str(w): t for s, w, t in batch}
            when = "CASE stop_id || arrival_seconds " + " ".join(
                f"WHEN '{k}' THEN TIMESTAMP '2026-01-01 {t}'" for k, t in times.items() if t) + " END"
            frame = frame.selectExpr("line", "route_id", "stop_id", "arrival_seconds", f"{when} AS event_timestamp")
            frame.write.mode("append").parquet(f"{tmp_path}/in")
            source = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
            windows.start(build(source), f"{tmp_path}/out", f"{tmp_path}/cp", mode, once=True).awaitTermination()
        return f"{tmp_path}/out"

    return run


def test_minutes_go_on_over_restarts_and_leave_out_late_rows(spark, feed):
    out = feed(
        windows.minutes, "update",
        [("a", 1, "10:00:10"), ("b", 1, "10:00:50")],
        [("c", 1, "10:00:20"), ("d", 1, "12:30:00"), ("e", 1, None)],
        [("f", 1, "10:00:30"), ("g", 1, "12:29:59")],  # the first is over an hour behind 12:30
    )
    got = {str(r["minuto"])[11:16]: r["total_llegadas"] for r in windows.minute_counts(spark, out).collect()}
    assert got == {"10:00": 3, "12:30": 1, "12:29": 1}


def test_a_prediction_polled_again_passes_once(spark, feed):
    poll = [("a", 60, "10:00:00"), ("b", 30, "10:00:00")]
    later = [("a", 50, "10:00:10"), ("b", 25, "10:00:10")]  # a: the same moment, b: another
    out = feed(windows.distinct_predictions, "append", poll, later, later)
    got = sorted((r["stop_id"], str(r["predicted"])[11:19]) for r in spark.read.parquet(out).collect())
    assert got == [("a", "10:01:00"), ("b", "10:00:30"), ("b", "10:00:35")]
