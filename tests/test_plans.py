"""Physical plans of the registered queries."""

import re

import pytest

from catalogue import QUERIES
from sluiceway import entities
from sluiceway.operators import aggregates, joins, ranking
from sluiceway.plans import product_performance, segment_performance, user_engagement
from sluiceway.quality.suite import Suite
from tests.conftest import plan_text

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def frames(spark):
    return {
        name: getattr(entities, name)(spark, FOLDER) for name in ("user_events", "user_profiles", "products", "transactions")
    }


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan_text(df))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_or_windows_over_everything(spark, name):
    plan = plan_text(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"windowspecdefinition\(specifiedwindowframe", line)


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_text(user_engagement.daily_metrics(entities.user_events(spark, FOLDER)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_filters_reach_the_scan(spark):
    orders = entities.table(spark, FOLDER, "orders").where("o_orderstatus = 'F' AND o_totalprice > 1000")
    pushed = plan_text(orders.select("o_orderkey")).split("PushedFilters: ")[1]
    assert pushed.startswith("[IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orde")


def test_active_filter_stays_below_the_profile_join(spark):
    f = frames(spark)
    plan = plan_text(user_engagement.daily_engagement(f["user_events"], f["user_profiles"]))
    assert plan.index("Join") < plan.index(">= 3")


def test_daily_metrics_aggregate_before_they_shuffle(spark):
    df = user_engagement.daily_metrics(entities.user_events(spark, FOLDER))
    assert len(shuffles(df)) == 2
    scan_to_shuffle = plan_text(df).split("Exchange")[-1]
    assert "partial_count(1)" in scan_to_shuffle


def test_product_joins_and_grouping_share_one_partitioning(no_broadcast):
    f = frames(no_broadcast)
    df = product_performance.product_performance(f["products"], f["user_events"], f["transactions"])
    keys = [re.sub(r"#\d+L?", "", key) for key in shuffles(df)]
    # events by product and user, events by product, sales by product, products; and the two sides of order lines
    assert sorted(keys) == sorted(["product_id, user_id", "product_id", "product_id", "product_id", "l_orderkey", "l_orderkey"])


def test_segments_shuffle_profiles_once(no_broadcast):
    f = frames(no_broadcast)
    df = segment_performance.segment_performance(f["user_profiles"], f["user_events"], f["transactions"])
    assert len(shuffles(df)) <= 12


def test_latest_limits_rows_before_the_shuffle(spark):
    events = entities.table(spark, FOLDER, "events")
    plan = plan_text(ranking.latest(events, ["user_id"], [events.ts.desc(), events.event_id.desc()]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_top_k_keeps_k_rows_per_task(spark):
    orders = entities.table(spark, FOLDER, "orders")
    assert "TakeOrderedAndProject(limit=3" in plan_text(ranking.top(orders, 3, orders.o_totalprice.desc()))


def test_semi_join_reduces_its_right_side_before_the_shuffle(no_broadcast):
    f = frames(no_broadcast)
    plan = plan_text(joins.join(f["user_profiles"], f["user_events"], "user_id", "left_semi"))
    assert "HashAggregate(keys=[user_id" in plan


def test_share_of_total_has_no_window(spark):
    sums = entities.table(spark, FOLDER, "part").groupBy("p_type").agg({"p_retailprice": "sum"})
    plan = plan_text(aggregates.with_share_of_total(sums, "sum(p_retailprice)", "share"))
    assert "Window" not in plan and "Subquery" in plan


def test_rules_are_one_aggregate_over_one_scan(spark):
    events = entities.user_events(spark, FOLDER)
    rules = [{"name": f"r{i}", "type": "range_check", "column": "revenue", "max_value": i} for i in range(8)]
    plan = plan_text(events.agg(*Suite(rules, events).columns()))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_broadcast_of_a_checked_dimension(no_broadcast):
    assert "BroadcastHashJoin" in plan_text(QUERIES["j13_broadcast"](no_broadcast, FOLDER))
