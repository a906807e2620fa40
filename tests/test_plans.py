"""Plan-shape checks over every registered query (no execution of the results).

* no Python UDF evaluation nodes anywhere (all work stays JVM-side);
* no cross product;
* the top-k query is planned with a partial window-group limit before its
  shuffle, so a hot key is never sorted whole in one task.
"""

import pytest

from orchard.plans.registry import QUERIES
from conftest import SF_SMALL

FORBIDDEN_ALWAYS = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"]
FORBIDDEN_CROSS = ["CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    # tuning keys run when they are built and return a table of a few local rows
    eager = ("tune_sweep", "tune_grid", "tune_refit", "tune_pick", "sort_by_metric")
    for k, fn in QUERIES.items():
        if k.startswith(eager):
            continue
        out[k] = _plan(fn(spark, SF_SMALL))
    return out


def test_no_python_udfs_and_no_cross_products(plans):
    for k, p in plans.items():
        for bad in FORBIDDEN_ALWAYS:
            assert bad not in p, (k, bad)
        for bad in FORBIDDEN_CROSS:
            assert bad not in p, (k, bad)


def test_topk_partial_limit_before_shuffle(plans):
    p = plans["topk_per_key"]
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scans_read_only_needed_columns(spark):
    from orchard.sources import views as V
    df = V.binary_big(spark, SF_SMALL)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in txt and "o_orderdate" not in txt
