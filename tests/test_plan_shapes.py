"""No query may pair rows blindly, gather its data in one task or run Python per row."""

import re

import pytest

from sitebooks.catalog import QUERIES

# One-row results (totals, watermarks) legitimately end in a single partition.
SCALARS = {
    "scalar_extremes", "surrogate_id", "retention_audit", "dq_null_counts", "dq_resolved_lookups",
    "dq_layer_counts", "dq_control_totals", "nbv_incremental", "tax_rate_load",
    "high_watermark_filter", "extract_since_target", "latest_snapshot", "overlap_pairs",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shape(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan
    if name not in SCALARS:
        assert "SinglePartition" not in plan


def test_latest_row_is_limited_before_the_shuffle(spark, sf_dir):
    plan = QUERIES["latest_by_key"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_ongoing_counts_read_twice_and_shuffle_the_rows_once(spark, sf_dir):
    df = QUERIES["ongoing_counts"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= 2  # profiles and rows
    rows = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert sorted("ReusedExchange" in line for line in rows) == [False, True]


@pytest.mark.parametrize("name, scans", [("match_transactions", 3), ("branch_union_resolve", 5)])
def test_inputs_are_read_once(spark, sf_dir, name, scans):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= scans


@pytest.mark.parametrize("name", ["retention_purge", "filtered_actuals"])
def test_dates_reach_the_scan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert any("date" in line.split("PushedFilters:")[1].split("]")[0] for line in plan.splitlines() if "PushedFilters:" in line)


@pytest.mark.parametrize("name", ["branch_union_resolve", "quantity_rules", "value_rules"])
def test_lease_columns_nobody_reads_are_not_carried(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TRI_ID_TX" in plan and "CST_BRAND_TX|" not in plan


@pytest.mark.parametrize("name, keys", [("curated_leases", "TRI_ID_TX, TRI_CONTROL_NUMBER_CN"), ("quantity_rules", "TRI_ID_TX")])
def test_wide_rows_are_not_sorted_before_their_exchange(spark, sf_dir, name, keys):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    wide = re.search(rf"hashpartitioning\({re.sub('[A-Z_]+', lambda m: m[0] + '#[0-9]+', keys)}, \d+\), REPARTITION_BY_COL.*?FileScan", plan, re.S)
    assert wide and "Sort [" not in wide[0] and "BroadcastHashJoin" in wide[0]


def test_copies_of_rules_are_dealt_before_they_are_combined(spark, sf_dir):
    plan = QUERIES["value_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(Lease_Clause_Legacy_Id#\d+[^)]*\), REPARTITION_BY_COL", plan)


def test_ongoing_counts_sort_neither_slots_nor_carries(spark, sf_dir):
    plan = QUERIES["ongoing_counts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window [sum(_w"):]
    window = window[: window.index("REPARTITION_BY_COL")]
    # read upwards: exchanged, sorted, then a column per slot; the carries are joined above
    assert window.count("Sort [") == 1 and window.index("CASE WHEN (_slot") < window.index("Sort [")
    assert "_carry" not in window and "_carry#" in plan[: plan.index("Window [sum(_w")]
