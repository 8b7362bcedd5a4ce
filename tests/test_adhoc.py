import json

import pytest

from tramline.plans import adhoc


def test_limit_is_added():
    assert adhoc.guard(" SELECT * FROM trips ") == "SELECT * FROM trips LIMIT 2000"
    assert adhoc.guard("select 1 limit 5") == "select 1 limit 5"


@pytest.mark.parametrize(
    "query",
    [
        "",
        "   ",
        "DELETE FROM stops WHERE stop_id = '7'",
        "SELECT 1 AS one; SELECT 2 AS two",
        "UPDATE routes SET route_type = 3",
        "WITH few AS (SELECT stop_id FROM stops) SELECT count(*) FROM few",
        "EXPLAIN SELECT * FROM trips",
        "SELECT * FROM trips -- all",
        "SELECT /* all */ * FROM trips",
        "SELECT 'please drop it' FROM trips",
    ],
)
def test_refused(query):
    with pytest.raises(adhoc.RefusedQuery):
        adhoc.guard(query)


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("adhoc") / "trips")
    spark.range(3000).selectExpr("string(id) AS trip_id", "id % 2 AS direction_id").write.parquet(path)
    spark.range(1).createOrReplaceTempView("hidden")
    return adhoc.isolated_session(spark, {"trips": path}), path


def test_only_the_given_tables_exist(session):
    own, path = session
    assert adhoc.table_names(own) == ["trips"]
    for query in (
        "SELECT * FROM hidden",
        "SELECT * FROM trips, hidden",
        f"SELECT * FROM parquet.`{path}`",
        f"SELECT * FROM trips JOIN parquet.`{path}` p USING (trip_id)",
    ):
        with pytest.raises(adhoc.RefusedQuery):
            adhoc.run(own, query)


def test_nothing_runs_code_or_reads_other_tables(spark, session, tmp_path):
    own, path = session
    spark.range(3).write.mode("overwrite").saveAsTable("adhoc_other")
    spark.range(3).createOrReplaceGlobalTempView("adhoc_global")
    try:
        for query in (
            "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
            "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home')",
            "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM trips",
            "SELECT TRANSFORM (trip_id) USING 'cat' FROM trips",
            "SELECT TRANSFORM (trip_id) USING r'cat' AS (b) FROM trips",
            "SELECT IDENTIFIER('refl' || 'ect')('java.lang.System', 'getProperty', 'java.version') FROM trips",
            "SELECT * FROM IDENTIFIER(reflect('java.lang.System', 'getProperty', 'user.home'))",
            "SELECT (SELECT max(n) FROM (SELECT reflect('java.lang.System', 'lineSeparator') AS n)) FROM trips",
            "SELECT trip_id FROM trips WHERE trip_id IN (SELECT string(id) FROM adhoc_other)",
            "SELECT * FROM adhoc_other",
            "SELECT * FROM default.adhoc_other",
            "SELECT * FROM global_temp.adhoc_global",
            "SELECT * FROM range(10)",
            "SELECT * FROM (WITH t AS (SELECT * FROM adhoc_other) SELECT * FROM t)",
            "SELECT FROM WHERE",
        ):
            with pytest.raises(adhoc.RefusedQuery):
                adhoc.run(own, query)
    finally:
        spark.sql("DROP TABLE adhoc_other")
        spark.catalog.dropGlobalTempView("adhoc_global")


def test_plain_queries_pass(session):
    own, _ = session
    for query, n in (
        ("SELECT 1 AS one", 1),
        ("SELECT DISTINCT direction_id FROM trips", 2),
        ("SELECT t.trip_id FROM trips t JOIN (SELECT max(trip_id) AS m FROM trips) x ON t.trip_id = x.m", 1),
        ("SELECT * FROM (WITH few AS (SELECT * FROM trips WHERE trip_id < '2') SELECT count(*) FROM few)", 1),
        ("SELECT trip_id, row_number() OVER (ORDER BY trip_id) AS n FROM trips LIMIT 3", 3),
        ("SELECT direction_id FROM trips WHERE EXISTS (SELECT 1 FROM trips) LIMIT 2", 2),
        ("SELECT * FROM VALUES (1), (2) AS v(a) UNION ALL SELECT 3", 3),
        ("SELECT explode(array(1, 2)) AS x", 2),
    ):
        assert adhoc.run(own, query).count() == n


def test_columns_of_one_name_and_truncation(session):
    own, _ = session
    found = json.loads(adhoc.run_json(own, "SELECT 1 AS a, 2 AS a, NULL AS b"))
    assert found["columns"] == ["a", "a_2", "b"]
    assert found["rows"] == [{"a": 1, "a_2": 2, "b": None}] and found["truncated"] is False
    cut = json.loads(adhoc.run_json(own, "SELECT trip_id FROM trips", 10))
    assert len(cut["rows"]) == 10 and cut["truncated"] is True
    assert json.loads(adhoc.run_json(own, "SELECT trip_id FROM trips LIMIT 10", 10))["truncated"] is False


def test_rows_are_bounded_whatever_the_limit_says(session):
    own, _ = session
    assert adhoc.run(own, "SELECT * FROM trips").count() == 2000
    assert adhoc.run(own, "SELECT * FROM trips LIMIT 1000000").count() == 2000
    inner = "SELECT a.trip_id FROM trips a JOIN (SELECT * FROM trips LIMIT 3000) b USING (trip_id)"
    assert adhoc.run(own, inner).count() <= 2000


def test_json_result(session):
    own, _ = session
    text = adhoc.run_json(
        own, "SELECT direction_id, count(*) AS n FROM trips GROUP BY 1 ORDER BY 1"
    )
    assert json.loads(text) == {
        "query": "SELECT direction_id, count(*) AS n FROM trips GROUP BY 1 ORDER BY 1 LIMIT 2000",
        "columns": ["direction_id", "n"],
        "rows": [{"direction_id": 0, "n": 1500}, {"direction_id": 1, "n": 1500}],
        "truncated": False,
    }
