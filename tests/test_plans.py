"""Architecture guards on the physical plans of the registered queries."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
}
NAMES = sorted(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_join_or_row_udf(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().toString()
    found = [why for marker, why in FORBIDDEN.items() if marker in plan]
    assert not found, f"{name}: {found}"


def test_scans_are_pruned(spark):
    df = entry.queries()["top_rated_books"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the lineitem scan reads only the three columns the query needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
