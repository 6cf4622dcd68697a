"""Physical plans: what must and must not be in them."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
EAGER = {"stream_scoring", "similar_title", "infer_social", "pipeline", "pipeline_run"}
LAZY = sorted(n for n in QUERIES if not n.startswith(("ml_", "scan_", "sink_", "csv_", "op")) and n not in EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_python(name, spark, sf):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_scan_prunes_and_pushes(spark, sf):
    plan = QUERIES["scan_parquet"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]
