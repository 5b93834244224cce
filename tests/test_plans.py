"""Plan properties the scale design relies on, checked on the physical
plans (no execution needed for the initial plan)."""

import pytest

from lodestar.plans.registry import load_all
from tests.conftest import SF_SMALL

E = load_all()
LAZY = sorted(n for n in E if not n.startswith(("k_", "m_", "s_csv", "s_json_opt", "s_external",
                                                 "s_parquet", "s_bucketed", "g_turtle")))


def _plan(spark, name):
    df = E[name].build(spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_map_side_partial_aggregation_before_join(spark):
    p = _plan(spark, "b1_revenue_by_type")
    # lineitem is reduced per part (partial + final) below the join with part
    join = p.index("Join")
    below = p[join:]
    assert "HashAggregate(keys=[l_partkey" in below and "partial_sum" in below
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_discount:double>" in p


def test_top_n_uses_partial_group_limit(spark):
    p = _plan(spark, "w_top3_orders_per_customer")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_pushed_to_scan(spark):
    p = _plan(spark, "p_point_lookup")
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in p


def test_latest_per_key_is_an_aggregate(spark):
    p = _plan(spark, "w_latest_event_per_user")
    assert "Window" not in p and "partial_max" in p


def test_bucketed_join_has_no_exchange_below_the_join(spark):
    df = E["s_bucketed_join"].build(spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below = p[p.index("SortMergeJoin"):]
    assert "Exchange" not in below and "Bucketed: true" in below
