"""Physical plans: filters and columns reach the scan, no cross joins, no Python in batch queries."""

from __future__ import annotations

import pytest

from shopstrata.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"
STREAMED = {"traffic_minute_stream", "trade_minute_stream", "ttl_dedup", "traffic_detail_stream", "trade_day_stream", "recon_batch_stream"}


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize(
    "name,pushed,columns",
    [
        ("gmv_day", "EqualTo(o_orderstatus,F)", "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate"),
        ("refund_total", "EqualTo(l_returnflag,R)", "l_extendedprice:double,l_returnflag:string,l_shipdate"),
        ("traffic_day", "EqualTo(event_type,view)", "ts:timestamp_ntz,user_id:bigint,event_type:string"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    formatted = spark._jvm.PythonSQLUtils.explainString(QUERIES[name](spark, DATA)._jdf.queryExecution(), "formatted")
    assert pushed in formatted
    assert f"ReadSchema: struct<{columns}" in formatted


def test_dimension_size_decides_the_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "gmv_by_nation")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    assert "BroadcastHashJoin" in plan(spark, "gmv_by_nation")
