"""Plan checks for every registered whole-table query (planned, not run)."""

import importlib

import pytest

from conftest import SF_SMALL

E = importlib.import_module("__spark_entry__")
# the streaming and training queries run jobs when called; their parts are covered elsewhere
SKIP = {"g1_train_metrics", "g3_predict", "g4_batch_score", "g1_binary_forest", "g3_binary_forest", "g4_binary_forest", "j1_stream_score",
        "j1_binary_forest", "j1_refresh_stream", "j2_stream_drift", "j3_stream_windows", "i08_stream_alert", "i11_stream_increase", "k6_restart_ledger", "a4_read_features", "a5_overwrite", "a6_baseline_json", "a7_live_json", "a9_audit"}
PYTHON_OK = {"i11_counter_increase"}   # one Arrow-batched mapInPandas per range partition


LIBRARY = {n for n in E.queries() if not n.startswith("op") and n != "pipeline"}


@pytest.mark.parametrize("name", sorted(LIBRARY - SKIP))
def test_plan_has_no_cross_join_and_no_row_udf(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in PYTHON_OK:
        assert "MapInPandas" not in plan and "PythonUDF" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = E.queries()["b01_hand_is_pair"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan and "l_extendedprice" not in plan


def test_newest_rows_are_cut_before_they_are_ranked(spark):
    """The cut is a top-N over the raw columns; what is decoded and ranked is the written cut, not the table."""
    from cardlens.operators import sampling
    from cardlens.sources import derived
    from cardlens.sources.tables import read_table

    raw = derived.with_deal_code(read_table(spark, SF_SMALL, "lineitem"))
    top = sampling.latest_rows(raw, 1000, "ship_ts", ("l_orderkey", "code"))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top and "Exchange" not in top
    plan = E.queries()["e5_latest_rows"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan and "lineitem" not in plan and "Sort" not in plan
    assert "TakeOrderedAndProject" in E.queries()["e8_min_rows_guard"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_short_windows_are_short_at_every_size(spark):
    """The window is short by construction, no limit gathers a table, and the rows would give a report without the guard."""
    from cardlens.operators import drift
    from cardlens.plans import queries_stats as qs

    plan = lambda name: E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan("e8_min_rows_guard") and "GlobalLimit" not in plan("h4_short_window")
    assert E.queries()["h4_short_window"](spark, SF_SMALL).count() == 0
    unguarded = drift.psi_report(qs._baseline(spark, SF_SMALL), qs._newest_live(spark, SF_SMALL, qs.LIVE_WINDOW - 1))
    assert unguarded.count() == 5


def test_no_long_predicate_below_the_spread(spark):
    """Filters that reach the scan or stand below the repartition are short: tests of stored columns, or of the deal's code."""
    from cardlens.plans import queries_ops, queries_stats
    from cardlens.functions import cards

    def predicates(df):
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        return [line.split("Filter ", 1)[1] for line in lines if "Filter " in line]

    valid, _ = cards.validate_hands(queries_ops._requests(spark, SF_SMALL))
    assert predicates(valid) and all(len(p) < 900 for p in predicates(valid))
    scan = next(line for line in valid._jdf.queryExecution().executedPlan().toString().split("\n") if "PushedFilters" in line)
    assert all(f"GreaterThanOrEqual({c},1)" in scan for c in ("S1", "C1")) or "PushedFilters: [" in scan
    live = derived_live(spark).filter(queries_stats.live_part())
    assert all(len(p) < 900 for p in predicates(live))


def derived_live(spark):
    from cardlens.sources import derived

    return derived.live(spark, SF_SMALL)
