"""Streaming chain: batch = stream, reruns are idempotent, rules act."""

import pytest
from pyspark.errors import StreamingQueryException

from retailflow.operators import json_orders
from retailflow.operators.expectations import VALID_ORDER_ID_DROP, VALID_ORDER_ID_FAIL
from retailflow.plans import queries as Q
from retailflow.schemas import MONEY_DECIMAL
from retailflow.sources import files, testdata
from retailflow.sources.landing import land_test_feeds, write_json
from retailflow.streaming.runner import Warehouse, run_json_streams, run_retail_streams, run_stream_table

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def streamed(spark):
    from retailflow.config import run_folder

    root = run_folder(spark, "test-stream")
    land = land_test_feeds(spark, SF_SMALL, f"{root}/landing")
    wh = Warehouse(f"{root}/warehouse")
    run_retail_streams(spark, land, wh, as_of=Q.DEFAULT_ORDER_DATE, money=MONEY_DECIMAL)
    return land, wh


def test_stream_equals_batch(spark, streamed):
    _, wh = streamed
    s = Q.as_doubles(spark.read.parquet(wh.table("orders_silver")))
    b = Q.q_orders_silver(spark, SF_SMALL)
    assert _rows(s.select(*b.columns)) == _rows(b)
    dc = spark.read.parquet(wh.table("dim_customer_silver_v2"))
    assert _rows(dc) == _rows(Q.q_dim_customer(spark, SF_SMALL).select(*dc.columns))


def test_small_micro_batches_give_the_same_rows(spark, streamed, scratch):
    land, _ = streamed
    wh = Warehouse(f"{scratch}/wh")
    runs = run_retail_streams(spark, land, wh, as_of=Q.DEFAULT_ORDER_DATE, money=MONEY_DECIMAL, max_files=2)
    assert len([p for p in runs["orders_bronze_v1"].recentProgress if p["numInputRows"] > 0]) > 1
    s = Q.as_doubles(spark.read.parquet(wh.table("orders_silver")))
    b = Q.q_orders_silver(spark, SF_SMALL)
    assert _rows(s.select(*b.columns)) == _rows(b)


def test_rerun_adds_nothing_and_new_file_adds_its_rows(spark, streamed):
    land, wh = streamed
    before = spark.read.parquet(wh.table("orders_silver")).count()
    run_retail_streams(spark, land, wh, as_of=Q.DEFAULT_ORDER_DATE, money=MONEY_DECIMAL)
    assert spark.read.parquet(wh.table("orders_silver")).count() == before
    # one more file of orders lands
    extra = testdata.raw_orders(spark, SF_SMALL).limit(7)
    extra.write.mode("append").parquet(f"{land.orders}/year_month=2099-01")
    run_retail_streams(spark, land, wh, as_of=Q.DEFAULT_ORDER_DATE, money=MONEY_DECIMAL)
    assert spark.read.parquet(wh.table("orders_silver")).count() == before + 7


def test_audit_columns_present(spark, streamed):
    _, wh = streamed
    df = spark.read.parquet(wh.table("orders_bronze_v1"))
    assert {"processing_time", "source_file"} <= set(df.columns)
    assert df.filter("source_file IS NULL OR processing_time IS NULL").count() == 0


def test_json_rules_drop_and_observe(spark, scratch):
    src = f"{scratch}/json"
    write_json(testdata.raw_json_orders(spark, SF_SMALL), f"{src}/orders")
    wh = Warehouse(f"{scratch}/wh")
    runs = run_json_streams(spark, src, wh, bronze_rules=(VALID_ORDER_ID_DROP,))
    total = testdata.raw_json_orders(spark, SF_SMALL).count()
    nulls = testdata.raw_json_orders(spark, SF_SMALL).filter("order_id IS NULL").count()
    assert nulls > 0
    assert spark.read.parquet(wh.table("orders_silver_demo3")).count() == total - nulls
    metrics = [p["observedMetrics"] for p in runs["orders_bronze_demo3"].recentProgress if p.get("observedMetrics")]
    seen = sum(m["orders_bronze_demo3_expectations"]["violations_valid_order_id"] for m in metrics)
    assert seen == nulls


def test_fail_rule_fails_the_stream(spark, scratch):
    src = f"{scratch}/json"
    write_json(testdata.raw_json_orders(spark, SF_SMALL), f"{src}/orders")
    raw = files.read_json_orders(spark, src, stream=True)
    df = json_orders.json_orders_bronze(raw, expectations=(VALID_ORDER_ID_FAIL,))
    with pytest.raises((RuntimeError, StreamingQueryException)):
        run_stream_table(df, Warehouse(f"{scratch}/wh"), "fails")


def test_fail_rule_fails_a_batch(spark):
    df = json_orders.json_orders_silver(
        testdata.raw_json_orders(spark, SF_SMALL), expectations=(VALID_ORDER_ID_FAIL,)
    )
    with pytest.raises(Exception):
        df.select("customer_id").collect()


def test_empty_source_streams_to_empty_tables(spark, scratch):
    import os

    src = f"{scratch}/json"
    os.makedirs(f"{src}/orders".removeprefix("file:"))  # the test session's shared folder is local
    wh = Warehouse(f"{scratch}/wh")
    runs = run_json_streams(spark, src, wh)
    assert runs["orders_silver_demo3"].exception() is None
