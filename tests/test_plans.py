"""Executed plans of the core queries stay on the scalable path."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

FORBIDDEN = ["Window", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list",
             "collect_set", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"]


@pytest.mark.parametrize("name", ["q_reconciled", "q_reconciled_dup", "q_conflict_audit",
                                  "q_quarantine_strict", "q_seq_audit_nullable", "q_upload_clean",
                                  "q_upload_audit"])
def test_no_unbounded_or_python_operators(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    for op in FORBIDDEN:
        assert op not in plan, f"{name} uses {op}"


def test_scans_are_pruned(spark):
    df = entry.queries()["q_exact_mismatch"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan  # the payload column is never read for the identity check
