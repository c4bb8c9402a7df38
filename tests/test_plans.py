"""The scale design as plan assertions: what must (and must not) appear in the plans."""
import os

import pytest
from pyspark.sql import functions as F

from mixlens.operators.allocate import allocate_sales
from mixlens.operators.clean import clean
from mixlens.plans.catalog import QUERIES
from mixlens.plans.context import context
from mixlens.sources.media_fact import media_from_tpch

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_move_no_whole_rows(spark):
    """Rows without a twin stay where they are read; only marked ones meet by all their columns."""
    from mixlens.operators.clean import drop_exact_duplicates, maybe_repeated
    raw = context(spark, SF).raw()
    marked = _plan(maybe_repeated(raw))
    assert "Exchange hashpartitioning(_d1" in marked and "hashpartitioning(activity_date" not in marked
    tree = drop_exact_duplicates(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.startswith("Union") and tree.count("Filter NOT") == 1   # one branch of unmarked rows, one of marked ones
    assert "Filter ((" in tree[:tree.index("Filter NOT")]


def test_row_fact_is_one_copy_clustered_by_year(spark):
    import re
    ctx = context(spark, SF)
    files = ctx.clean_fact().inputFiles()
    years = [re.search("year=([0-9]+)", f).group(1) for f in files]
    assert len(files) == len(set(years))                                # one file a year at this size
    assert set(ctx.rows().inputFiles()) > set(files)                    # the same files and the weekly statistics
    assert len(ctx.rows().inputFiles()) - len(files) < 10


def test_allocation_broadcasts_week_stats_and_has_no_row_window(spark):
    rows = allocate_sales(clean(media_from_tpch(spark, SF)))
    plan = _plan(rows.select("week", "estimated_sales"))
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan                      # never a window over row-level data


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["filtered_weekly"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(media_type" in plan or "In(media_type" in plan
    assert "ReadSchema: struct<media_type:string,device:string,spend" in plan


def test_grouping_sets_combine_before_the_shuffle(spark):
    from mixlens.operators.efficiency import breakdown_all_dims
    rows = context(spark, SF).rows()
    plan = _plan(breakdown_all_dims(rows, ["media_type", "channel"]))
    assert plan.count("Exchange hashpartitioning") == 1       # one shuffle, of partial sums by dimension value
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "HashAggregate" in above and "HashAggregate" in below


def test_panel_windows_partition_by_series(spark):
    from mixlens.operators.features import engineer_features
    from mixlens.operators.panel import panel_weekly
    ctx = context(spark, SF)
    panel = panel_weekly(ctx.rows(), ctx.weekly_sales(), ["channel"])
    plan = _plan(engineer_features(panel).select("series", "week", "sales_lag_1", "sales_ewm_4"))
    assert "hashpartitioning(series" in plan
    assert "SinglePartition" not in plan


def test_kpi_summary_needs_no_join(spark):
    from mixlens.operators.eda import kpi_summary
    plan = _plan(kpi_summary(context(spark, SF).clean_fact()))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert F is not None


def test_source_join_carries_no_keys_it_is_done_with(spark):
    """Orders, suppliers and parts are reduced to their columns of the fact before line items are shuffled with them."""
    plan = media_from_tpch(spark, SF)._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join Inner" in line]
    assert "l_partkey" in joins[0] and "l_suppkey" in joins[1] and "l_orderkey" in joins[2]      # the part's wide columns last
    outer = plan.children().apply(0)
    left = outer.children().apply(0).output().mkString(" ")
    assert not any(k in left for k in ("orderkey", "custkey", "suppkey", "nationkey", "mktsegment", "orderstatus"))


def test_row_fact_moves_whole_rows_once(spark):
    """Duplicates are compared where rows are dealt for their year: no second exchange, no hash table before the first."""
    from mixlens.operators.clean import clean as cleaned
    raw = context(spark, SF).raw()
    plan = _plan(cleaned(raw, pieces=3, by=F.year("week")))
    few = plan[:plan.index("rangepartitioning(_by")]
    assert few.count("Exchange") == 1 and "HashAggregate" in few                                 # the aggregates stand above it
