"""Plan-shape checks on every registered query with an oracle: no cross joins,
partial aggregation before shuffles, filters and projections reaching the scan."""

import pytest

import __spark_entry__ as entry_mod

NAMES = sorted(k for k in entry_mod.oracle_sql() if not k.startswith("op"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join(spark, sf_small, name):
    plan = _plan(entry_mod.queries()[name](spark, sf_small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan


def test_group_mean_count_plan(spark, sf_small):
    plan = _plan(entry_mod.queries()["group_mean_count"](spark, sf_small))
    assert "partial_avg" in plan and "partial_count" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_filter_range_pushdown(spark, sf_small):
    plan = _plan(entry_mod.queries()["filter_range"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_discount), IsNotNull(l_tax)" in plan


def test_split_leaves_rows_in_place(spark, sf_small):
    """Whole rows meet the one cut of their class in a broadcast join; nothing wide is shuffled for the split."""
    from tessera.operators.split import train_test_split
    li = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = _plan(train_test_split(li, "o_orderkey", "o_orderstatus"))
    assert "BroadcastHashJoin [_gn" in plan
    assert not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "o_totalprice" in x]
