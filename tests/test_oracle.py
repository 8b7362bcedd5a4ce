"""Every registered query against its oracle, and the comparison itself."""

import pytest

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES
from checks.compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


# Operators no query may plan, whatever the input size: pairings of all rows, rows
# sent through Python, and windows, whose groups cannot be split.
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "Window [",
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [f for f in FORBIDDEN if f in plan] == []
    assert differences(df, con, ORACLES[name]) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT 1 AS a, 'y' AS b",
        "SELECT 1 AS a, 'x' AS c",
        "SELECT 1.5 AS a, 'x' AS b",
        "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 1, 'x'",
    ],
)
def test_differences_are_found(frame, con, sql):
    assert differences(frame("a INT, b STRING", (1, "x")), con, sql)
