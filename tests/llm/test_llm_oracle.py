"""The registered corpus queries: those that SQL can express against their SQL, all by their promises."""

import pytest

from checks.compare import differences, oracle_connection
from tramline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
IN_SQL = {
    "op1_substring_dedup", "op3_decontamination", "op7_secret_ledger", "op8_seekable_warc",
    "op11_audit_repair", "op12_prefix_bands", "op13_token_assembly",
}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) == IN_SQL


@pytest.mark.parametrize("name", ["op3_decontamination", "op7_secret_ledger"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_all_rows(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
