"""No query may join everything with everything or order a whole table in one task."""

import re

import pytest

import __spark_entry__ as entry
from cellsurvey import session
from cellsurvey.functions import ranking
from cellsurvey.operators import network
from cellsurvey.plans import catalog_annotation, catalog_network, stages

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plans(monkeypatch):
    """Plans of the materialised intermediates of a query."""
    seen = []
    real = session.durable

    def spy(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    for module in (session, ranking, network, stages, catalog_network, catalog_annotation):
        if hasattr(module, "durable"):
            monkeypatch.setattr(module, "durable", spy)
    return seen


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_plan(spark, plans, name):
    df = entry.queries()[name](spark, FOLDER)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        for line in plan.splitlines():  # Window [...], [partition], [order]
            assert not re.search(r"Window \[.*\], \[\], \[", line), line
        assert "BatchEvalPython" not in plan  # row-at-a-time Python


def test_pruning_and_pushdown(spark):
    plan = entry.queries()["chemistry_from_reads"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    plan = entry.queries()["results_by_project"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(proj_id", plan)
    plan = entry.queries()["ledger_todo"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
