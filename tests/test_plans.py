"""Physical-plan checks: broadcast of the monthly side, pushed filters and
pruned scans, no Python evaluation anywhere in the registered queries."""

import re

import pytest

import __spark_entry__ as E
from tablewright import session
from tablewright.operators import profile as P
from tablewright.operators import timeseries as T
from tablewright.plans import catalog
from tablewright.plans import fixtures as X

from tables import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_monthly_join_is_broadcast(spark):
    """The rates are the broadcast side of the join on the month, and the fact side isn't shuffled for it."""
    joined = T.join_monthly(X.table(spark, SF_SMALL, "lineitem"), catalog._monthly_rates(spark, SF_SMALL), "l_shipdate")
    plan = _plan(joined)
    assert re.search(r"BroadcastHashJoin \[year_month#\d+\], \[year_month#\d+\], LeftOuter, BuildRight", plan)
    fact = plan[:plan.index("BroadcastExchange")]
    assert "lineitem.parquet" in fact and "Exchange hashpartitioning" not in fact and "SortMergeJoin" not in plan


def test_filter_pushed_and_columns_pruned(spark):
    plan = _plan(catalog.filter_category(spark, SF_SMALL).select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    scan = next(x for x in plan.splitlines() if "lineitem.parquet" in x)
    assert scan.split("ReadSchema: ")[1] == "struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string>"


@pytest.mark.parametrize("name", ["box_stats", "numeric_summary", "histogram_bins", "flagship", "regional_trend",
                                  "group_median_topk", "stage_counts", "category_share"])
def test_input_is_evaluated_once(spark, monkeypatch, name):
    """Over the write of the counted values and what reads it, the facts are scanned once (stage_counts: and counted raw)."""
    plans = []
    plain = session.materialize
    monkeypatch.setattr("tablewright.operators.quantiles.materialize",
                        lambda df, *a: (plans.append(_plan(df)), plain(df, *a))[1])
    plans.append(_plan(E.queries()[name](spark, SF_SMALL)))
    assert sum(p.count("lineitem.parquet") for p in plans) == (2 if name == "stage_counts" else 1)


def test_building_a_plan_runs_no_job_but_the_named_write(spark, monkeypatch):
    monkeypatch.setattr("tablewright.operators.quantiles.materialize", lambda df, *a: df)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans only")
    try:
        sales = X.sales(spark, SF_SMALL)
        before = len(tracker.getJobIdsForGroup("plans"))
        P.box_stats(sales, "close_price")
        P.numeric_summary(sales, ["close_price"])
        assert len(tracker.getJobIdsForGroup("plans")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in ("csv_typed_scan", "series_csv_scan", "sink_roundtrip")])
def test_no_python_udf_and_no_cross_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "EvalPython" not in plan
    # one-row statistics are attached by broadcast; never a shuffled cross product
    assert "CartesianProduct" not in plan
    assert plan.count("NestedLoopJoin") == plan.count("BroadcastNestedLoopJoin BuildRight")
