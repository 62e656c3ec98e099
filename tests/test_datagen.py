"""Generator: deterministic whatever the partitioning; fault rates hold."""

import pytest
from pyspark.sql import functions as F

from retailflow.operators import datagen
from retailflow.operators.bronze import orders_bronze


def test_same_rows_regardless_of_partitions(spark):
    a = datagen.orders(datagen.ids(spark, 5000))
    b = datagen.orders(datagen.ids(spark, 5000).repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_order_fault_rates(spark):
    n = 40000
    df = datagen.orders(datagen.ids(spark, n), n_customers=100, n_products=50)
    r = df.agg(
        F.avg(F.col("customer_id").isNull().cast("int")).alias("cust_null"),
        F.avg(F.col("discount").isNull().cast("int")).alias("disc_null"),
        F.avg(F.col("shipping_cost").isNull().cast("int")).alias("ship_null"),
        F.avg((F.col("quantity") < 0).cast("int")).alias("neg_qty"),
        F.avg((F.col("discount") >= 1).cast("int")).alias("big_disc"),
        F.avg((~F.col("order_date").rlike(r"^\d{4}-\d{2}-\d{2}$")).cast("int")).alias("bad_date"),
        F.min("product_id").alias("pmin"),
        F.max("product_id").alias("pmax"),
    ).first()
    assert r.cust_null == pytest.approx(0.01, abs=0.004)
    assert r.disc_null == pytest.approx(0.04, abs=0.006)
    assert r.ship_null == pytest.approx(0.02, abs=0.005)
    assert r.neg_qty == pytest.approx(0.02, abs=0.005)
    assert r.big_disc == pytest.approx(0.01 * 0.96, abs=0.004)
    assert r.bad_date == pytest.approx(0.15, abs=0.01)
    assert (r.pmin, r.pmax) == (1, 50)
    # the unreadable quarter of the bad dates is all that bronze cannot parse
    unparsed = orders_bronze(df, audit=False).filter("order_date IS NULL").count() / n
    assert unparsed == pytest.approx(0.15 / 4, abs=0.006)


def test_geographies_and_products(spark):
    geo = datagen.geographies(datagen.ids(spark, 50), n_total=50).collect()
    countries = [r.country for r in sorted(geo, key=lambda r: r.geography_id)]
    assert countries == ["USA"] * 30 + ["Canada"] * 10 + ["Mexico"] * 10
    assert [r.state for r in sorted(geo, key=lambda r: r.geography_id)][:6] == ["CA", "NY", "TX", "FL", "IL", "CA"]
    prods = datagen.products(datagen.ids(spark, 20000))
    r = prods.agg(
        F.avg((F.col("price") < 0).cast("int")).alias("neg"),
        F.avg(F.col("category").isNull().cast("int")).alias("nocat"),
        F.countDistinct("category").alias("cats"),
    ).first()
    assert r.neg == pytest.approx(0.05, abs=0.008) and r.nocat == pytest.approx(0.08, abs=0.01) and r.cats == 8


def test_customers_phone_shape(spark):
    c = datagen.customers(datagen.ids(spark, 2000))
    bad = c.filter(F.col("phone").isNotNull() & ~F.col("phone").rlike(r"^\d{3}-\d{3}-\d{4}$")).count()
    assert bad == 0
