"""The whole pipeline: landing -> streams -> gold fan-out -> catalog."""

from collections import Counter

import pytest

from retailflow.config import DEFAULT_AS_OF, DEFAULT_ORDER_DATE
from retailflow.operators.expectations import VALID_ORDER_ID_DROP
from retailflow.plans import queries as Q
from retailflow.plans.pipeline import DATASETS, register_tables, run_pipeline
from retailflow.schemas import MONEY_DECIMAL
from retailflow.sources.landing import land_test_feeds
from retailflow.streaming.runner import Warehouse

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def pipeline(spark):
    from retailflow.config import run_folder

    root = run_folder(spark, "test-pipeline")
    land = land_test_feeds(spark, SF_SMALL, f"{root}/landing")
    wh = Warehouse(f"{root}/warehouse")
    run_pipeline(spark, land, wh, as_of=DEFAULT_AS_OF, money=MONEY_DECIMAL, order_date_default=DEFAULT_ORDER_DATE, json_rules=((VALID_ORDER_ID_DROP,), ()))
    return wh


def _bag(df, cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "table,query",
    [
        ("sales_by_date", Q.q_sales_by_date),
        ("sales_by_category", Q.q_sales_by_category),
        ("sales_by_geography", Q.q_sales_by_geography),
        ("customer_analytics", Q.q_customer_analytics),
        ("product_performance", Q.q_product_performance),
        ("monthly_sales_trend", Q.q_monthly_sales_trend),
    ],
)
def test_gold_tables_equal_batch_queries(spark, pipeline, table, query):
    stored = spark.read.parquet(pipeline.table(table))
    batch = query(spark, SF_SMALL)
    assert sorted(stored.columns) == sorted(batch.columns)
    assert _bag(stored, batch.columns) == _bag(batch, batch.columns)


def test_json_gold_with_drop_rule(spark, pipeline):
    stored = spark.read.parquet(pipeline.table("orders_by_date_gold_demo3"))
    batch = Q.q_expect_drop_null_id(spark, SF_SMALL)
    assert stored.groupBy().sum("total_daily_orders").first()[0] == batch.count()


def test_invariants_across_gold_tables(spark, pipeline):
    totals = [
        spark.read.parquet(pipeline.table(t)).groupBy().sum("total_revenue").first()[0]
        for t in ("sales_by_date", "sales_by_category", "sales_by_geography", "monthly_sales_trend")
    ]
    assert max(totals) - min(totals) < 1e-6 * abs(totals[0])
    shares = spark.read.parquet(pipeline.table("sales_by_category")).groupBy().sum("revenue_share_pct").first()[0]
    assert shares == pytest.approx(100.0)
    silver = spark.read.parquet(pipeline.table("orders_silver"))
    assert silver.filter("discount > 1").count() == 0


def test_register_tables(spark, pipeline):
    names = register_tables(spark, pipeline, "retail_test", use=True)
    assert spark.catalog.currentDatabase() == "retail_test"
    spark.catalog.setCurrentDatabase("default")
    assert "retail_test.sales_by_category" in names and len(names) == len(DATASETS)
    t = spark.catalog.getTable("retail_test.orders_silver")
    assert t.description == "Order fact table enriched with dimensions"
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES retail_test.orders_silver").collect()}
    assert props.get("quality") == "silver" and props.get("dataset.table_type") == "fact"
    assert spark.table("retail_test.sales_by_category").count() > 0


def test_declarative_batch_flows_match_runner(spark, pipeline):
    """The definition file's materialized views, evaluated over the tables
    of a finished run, give the runner's gold tables (the rank's lineage
    cuts written as tables, as the pipelines runner would)."""
    import importlib
    import sys

    from pyspark.pipelines.graph_element_registry import graph_element_registration_context

    from test_declarative import Recorder

    register_tables(spark, pipeline, "retail_decl", use=True)
    try:
        rec = Recorder()
        sys.modules.pop("retailflow.plans.declarative", None)
        with graph_element_registration_context(rec):
            importlib.import_module("retailflow.plans.declarative")
        for helper in ("product_sales", "product_revenue_ranges"):
            rec.flows[helper].func().write.mode("overwrite").saveAsTable(f"retail_decl.{helper}")
        for name in ("sales_by_category", "sales_by_date", "product_performance", "monthly_sales_trend"):
            got = rec.flows[name].func()
            stored = spark.read.parquet(pipeline.table(name))
            assert _bag(got, stored.columns) == _bag(stored, stored.columns), name
    finally:
        spark.catalog.setCurrentDatabase("default")
