"""A third of all orders on one customer key and another third with a NULL
key: the order fact's shuffle join to a (non-broadcast) customer dimension
is split by AQE, and the results stay whole."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from retailflow.operators import gold, silver

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _inputs(spark, n):
    oid = F.col("id")
    orders = spark.range(n).select(
        oid.alias("order_id"),
        F.when(oid % 3 == 0, F.lit(None)).when(oid % 3 == 1, F.lit(7)).otherwise(oid % 4000 + 100).cast("long").alias("customer_id"),
        (oid % 1000).alias("product_id"),
        F.lit(2).cast("long").alias("quantity"),
        F.lit(10.0).alias("unit_price"),
        F.lit(0.5).alias("discount"),
        F.lit(1.0).alias("shipping_cost"),
        F.lit("2024-01-01").cast("date").alias("order_date"),
    )
    products = spark.range(1000).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category"),
        F.lit(5.0).alias("price"), F.lit(2.0).alias("cost"),
    )
    customers = spark.range(5000).select(
        F.col("id").alias("customer_id"), F.lit("n").alias("full_name"), F.lit("X").alias("country"),
        F.lit("Y").alias("state"), F.lit("Z").alias("city"),
    )
    return orders, products, customers


def test_hot_and_null_keys_are_split_and_results_whole(spark):
    n = 300_000
    with conf(spark, SKEW_CONF):
        orders, products, customers = _inputs(spark, n)
        df = silver.orders_silver(orders, products, customers)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == n
    assert sum(1 for r in rows if r.customer_id == 0 and r.country is None) == n // 3
    assert sum(1 for r in rows if r.customer_id == 7 and r.country == "X") == n // 3


def test_hot_group_aggregates_whole(spark):
    n = 300_000
    orders, products, customers = _inputs(spark, n)
    enr = gold.orders_enriched(silver.orders_silver(orders, products, customers))
    by_cust = {r.customer_id: r for r in gold.customer_analytics(enr, sort=False).collect()}
    assert by_cust[0].total_orders == n // 3 and by_cust[7].total_orders == n // 3
    assert by_cust[7].lifetime_value == (n // 3) * 2 * 10.0 * 0.5
    assert sum(r.total_orders for r in by_cust.values()) == n
