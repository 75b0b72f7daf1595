"""Plans as they would be at scale: no small-table broadcast to hide behind."""

import re

import pytest
from pyspark.sql import functions as F

from docfold.operators import checks as C
from docfold.operators.merge import upsert
from docfold.plans import table_queries as Q

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def scans(text, table=None):
    return [m for m in re.findall(r"FileScan parquet.*", text) if table is None or f"{table}.pa" in m or f"/{table}" in m]


def test_no_query_plans_a_cross_join(spark, plan):
    for name in ("quality_suite", "row_count_match", "upsert_orders", "page_totals", "latest_snapshot_overall"):
        text = plan(Q.QUERIES[name](spark, DATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_not_null_and_count_checks_share_one_scan(spark, plan):
    text = plan(Q.not_null_suite(spark, DATA))
    assert len(scans(text)) == 1
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double,props:string>" in text


def test_unique_check_counts_before_the_shuffle_and_reads_only_keys(spark, plan):
    text = plan(Q.pk_unique_lineitem(spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "partial_count" in text and "Window" not in text


def test_two_way_link_uses_one_join(spark, plan):
    orders, lineitem = Q.table(spark, DATA, "orders"), Q.table(spark, DATA, "lineitem")
    text = plan(
        C.run_suite(
            [
                C.foreign_key(lineitem, orders, ["l_orderkey"], ["o_orderkey"], "FK", "lineitem"),
                C.min_children(orders, lineitem, ["o_orderkey"], ["l_orderkey"], "MIN", "orders"),
            ]
        )
    )
    assert len(re.findall(r"SortMergeJoin|ShuffledHashJoin", text)) == 1
    assert len(scans(text)) == 2


def test_upsert_reads_each_side_as_little_as_it_can(spark, plan):
    orders = Q.table(spark, DATA, "orders").select("o_orderkey", "o_orderstatus")
    text = plan(upsert(orders, orders.withColumn("o_orderstatus", F.lit("F")), ["o_orderkey"]))
    assert len(re.findall(r"SortMergeJoin|ShuffledHashJoin", text)) == 1
    assert "partial_count" in text


def test_hot_keys_are_a_bounded_broadcast(spark, plan):
    text = plan(Q.pk_violations_lineitem(spark, DATA))
    broadcasts = text.count("BroadcastExchange")
    assert broadcasts and text.count("TakeOrderedAndProject(limit=1000") == broadcasts


def test_documents_are_parsed_once(spark, plan):
    text = plan(Q.bridge_order_parts(spark, DATA))
    assert text.count("parseJson") == 1


def test_date_filters_reach_the_scan(spark, plan):
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan(Q.incoming_orders(spark, DATA))


def test_snapshot_ranking_is_limited_before_its_shuffle(spark, plan):
    text = plan(Q.retained_snapshots(spark, DATA))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_stored_documents_are_read_by_field(spark, plan, tmp_path):
    from docfold.operators.flatten import bridge, flatten
    from docfold.plans import documents as D

    Q.raw_lines(spark, DATA).write.parquet(f"{tmp_path}/lines")
    Q.raw_orders(spark, DATA).write.parquet(f"{tmp_path}/orders")
    flat = plan(flatten(spark.read.parquet(f"{tmp_path}/orders"), D.ORDER_FIELDS).select("order_id", "total"))
    assert "ReadSchema: struct<raw_data:struct<0:bigint,1:double>>" in flat
    pairs = plan(bridge(spark.read.parquet(f"{tmp_path}/lines"), D.ORDER_PARTS))
    assert "ReadSchema: struct<raw_data:struct<0:bigint,1:variant>>" in pairs
