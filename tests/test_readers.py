"""Real-world customer files, bronze column order, the refresh of tables and
the skew of the streamed order fact."""

import pytest
from pyspark.sql import functions as F

from retailflow import schemas
from retailflow.operators import bronze, silver
from retailflow.operators.json_orders import utc_timestamp
from retailflow.sources import files
from retailflow.streaming.runner import Warehouse, refresh_table, run_stream_table
from test_skew import SKEW_CONF, conf

HEADER = "customer_id,first_name,last_name,email,phone,geography_id,registration_date"


def land(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_a_swapped_header_fails_and_is_read_by_name_when_asked(spark, scratch):
    path = land(spark, f"{scratch}/swapped", "last_name,customer_id,first_name,email,phone,geography_id,registration_date,tier", "Li,7,Ann,,1,2.0,2020-01-02,gold")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_customers(spark, path, stream=False).collect()
    schema = files.header_schema(spark, path, schemas.customer_schema())
    row = bronze.customer_bronze(files.read_customers(spark, path, stream=False, schema=schema), audit=False).first()
    assert (row.customer_id, row.first_name, row.last_name, row.geography_id, row.tier) == (7, "Ann", "Li", 2, "gold")


def test_unreadable_ids_and_broken_lines_leave_a_trace(spark, scratch):
    path = land(spark, f"{scratch}/bad", HEADER, "X9,A,B,,1,2.0,2020-01-02", "8,A,B", "9007199254740993,A,B,,1,2.5,2020-01-02")
    raw = files.read_customers(spark, path, stream=False, corrupt_column="_line")
    rows = {r.customer_id_text: r for r in bronze.customer_bronze(raw, audit=False, keep_text=True).collect()}
    assert rows["X9"].customer_id is None and rows["X9"].geography_id == 2 and rows["X9"]["_line"] is None
    assert rows["8"].customer_id == 8 and rows["8"]["_line"] == "8,A,B"
    exact = rows["9007199254740993"]
    assert exact.customer_id == 9007199254740993 and exact.geography_id is None and exact.geography_id_text == "2.5"


@pytest.mark.parametrize("stream", [False, True])
def test_bronze_columns_are_in_the_declared_order(spark, scratch, stream):
    land(spark, f"{scratch}/customers", HEADER, "1,A,B,,1,2.0,2020-01-02")
    orders = spark.createDataFrame([(1, None, 2, "2024-01-01", 1, 1.0, 0.0, 0.0)], schemas.order_schema())
    orders.write.parquet(f"{scratch}/orders/year_month=2024-01")
    customers = bronze.customer_bronze(files.read_customers(spark, f"{scratch}/customers", stream=stream))
    assert customers.columns == [
        "customer_id", "first_name", "last_name", "email", "phone", "geography_id",
        "processing_time", "source_file", "registration_date",
    ]
    orders = bronze.orders_bronze(files.read_orders(spark, f"{scratch}/orders", stream=stream))
    assert orders.columns == [
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "discount", "shipping_cost",
        "processing_time", "source_file", "order_date",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_any_session(spark, zone):
    texts = ["2022-01-01T00:30:00+05:00", "1640390400", "2024-03-10 02:30:00", "2022-01-01T00:30:00Z", "2022-01-01 00:30:00.25 -0130", "soon", None]
    with conf(spark, {"spark.sql.session.timeZone": zone}):
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(utc_timestamp("t").cast("string").alias("u")).collect()
    assert [r.u for r in got] == ["2021-12-31 19:30:00", "2021-12-25 00:00:00", "2024-03-10 02:30:00", "2022-01-01 00:30:00", "2022-01-01 02:00:00.25", None, None]


def test_a_failed_refresh_leaves_the_table(spark, scratch):
    wh = Warehouse(scratch)
    refresh_table(spark.range(5), wh, "t")
    refresh_table(spark.range(7), wh, "t")
    assert spark.read.parquet(wh.table("t")).count() == 7
    with pytest.raises(Exception):
        refresh_table(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), wh, "t")
    assert spark.read.parquet(wh.table("t")).count() == 7


def test_hot_keys_of_the_streamed_fact_are_split(spark, scratch):
    n = 200_000
    i = F.col("id")
    spark.range(n).select(
        i.alias("order_id"),
        F.when(i % 3 == 0, None).when(i % 3 == 1, 7).otherwise(i % 4000 + 100).cast("double").alias("customer_id"),
        (i % 1000).alias("product_id"), F.lit("2024-01-01").alias("order_date"), F.lit(2).cast("long").alias("quantity"),
        F.lit(10.0).alias("unit_price"), F.lit(0.5).alias("discount"), F.lit(1.0).alias("shipping_cost"),
    ).write.parquet(f"{scratch}/orders")
    spark.range(1000).select(
        i.alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category"), F.lit(5.0).alias("price"), F.lit(2.0).alias("cost")
    ).write.parquet(f"{scratch}/products")
    spark.range(5000).select(
        i.alias("customer_id"), F.lit("n").alias("full_name"), F.lit("X").alias("country"), F.lit("Y").alias("state"), F.lit("Z").alias("city")
    ).write.parquet(f"{scratch}/customers")
    with conf(spark, SKEW_CONF):
        orders = bronze.orders_bronze(files.read_orders(spark, f"{scratch}/orders"))
        fact = silver.orders_silver(orders, spark.read.parquet(f"{scratch}/products"), spark.read.parquet(f"{scratch}/customers"))
        query = run_stream_table(fact, Warehouse(scratch), "fact")
        plan = query._jsq.explainInternal(False)
    assert "skew=true" in plan
    assert spark.read.parquet(Warehouse(scratch).table("fact")).count() == n
