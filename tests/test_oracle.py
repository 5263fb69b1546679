"""Every registered query equals its SQL twin, and its plan stays distributed."""

import pytest

import __spark_entry__ as entry
from candlelake.plans.oracles import oracle_sql
from candlelake.plans.registry import QUERIES
from tests.oracle import connect, differences

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# their panel of common dates is empty on the smallest tables
NEEDS_DATES = {
    "aligned_panel", "panel_with_fallback", "correlation_long", "candidate_weights", "candidate_scores", "optimal_candidate",
    "portfolio_metrics", "portfolio_returns", "portfolio_backtest", "diversification", "ranked_weights", "scenario_row",
    "publish_scenario", "panel_fallback_cases", "bitmap_common_dates", "strict_runs", "panel_allocation", "panel_kpis", "panel_value_path", "panel_corr_subset", "panel_search_space", "guard_report",
}
# results that may be empty
MAY_BE_EMPTY = {"skipped_symbols", "spike_events", "stored_spikes", "ticker_except", "snapshot_quality"}
# plan nodes that no query may contain
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def connections():
    return {sf_dir: connect(sf_dir) for sf_dir in (SMALL, LARGER)}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connections, name):
    sf_dir = LARGER if name in NEEDS_DATES else SMALL
    df = entry.queries()[name](spark, sf_dir)
    assert differences(df, connections[sf_dir], entry.oracle_sql()[name]) == []
    assert name in MAY_BE_EMPTY or not df.isEmpty()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [node for node in FORBIDDEN if node in plan] == []


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["portfolio_type", "date", "portfolio_value"]
