"""Every registered query against its SQL twin, and the shape of the plans."""

import os

import pytest

import oracle
from signalbase.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, FOLDER))
    assert sum(rows.values()) > 0 or name == "dead_letters"
    if name in ORACLES:
        want_columns, want = oracle.duck_rows(duck, ORACLES[name])
        assert columns == want_columns
        assert rows == want


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


PLANNED = [n for n in sorted(QUERIES) if not n.startswith(("read_", "stream_", "full_"))]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_products_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_scans_read_only_what_is_used(spark):
    plan = QUERIES["dead_letters"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    plan = QUERIES["assign_ids"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,_place:bigint>" in plan
