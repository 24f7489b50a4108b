"""Registered queries against their check SQL, and the shape of their plans."""

import duckdb
import pytest
from conftest import ROOT

import __spark_entry__ as entry_module
from check import TABLES, normal

NAMES = [
    "asof_history",
    "business_metrics",
    "calibration_quantile",
    "call_list",
    "chronological_split",
    "collection_queue",
    "customer_timeline",
    "dq_metrics",
    "drift_report",
    "event_asof",
    "feature_matrix",
    "fault_injection",
    "gold_customer",
    "history_audit",
    "live_performance",
    "model_metrics",
    "monthly",
    "outcomes",
    "segments",
    "strategy_comparison",
    "v_collection_queue",
    "v_pipeline_health",
]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, root, oracle, name):
    got = normal(entry_module.queries()[name](spark, root).toPandas())
    want = normal(oracle.execute(entry_module.oracle_sql()[name]).fetch_df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want), f"{name}: {len(got)} against {len(want)} rows"


def test_every_check_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 110


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() == 20 and df.columns[0] == "rank"


PLANS = [
    "asof_history",
    "baseline_predict",
    "collection_queue",
    "drift_report",
    "feature_matrix",
    "gold_customer",
    "leaky_vs_pit",
    "live_performance",
    "model_metrics",
    "outcomes",
    "segments",
    "v_invoice_detail",
]


@pytest.mark.parametrize("name", PLANS)
def test_plans_have_no_cross_join_and_no_python(spark, root, name):
    plan = entry_module.queries()[name](spark, root)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert operator not in plan


def test_scans_read_only_what_they_need(spark, root):
    plan = entry_module.queries()["portfolio_kpis"](spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,O)" in plan and "c_name" not in plan
