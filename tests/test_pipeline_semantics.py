"""Golden semantics of the silver and gold steps on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retailflow.operators import gold, silver
from retailflow.operators.ranking import dense_rank_desc

AS_OF = dt.date(2005, 1, 1)
D1 = dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def dims(spark):
    geo_b = spark.createDataFrame(
        [(1, "USA", "CA", "City_1", " 12 345 "), (None, "X", "Y", "Z", "1")],
        "geography_id bigint, country string, state string, city string, postal_code string",
    )
    cust_b = spark.createDataFrame(
        [
            (1, "A", "B", 1, D1, 5551234567),
            (2, None, None, None, None, None),
            (None, "Z", "Z", 1, D1, None),
            (3, "C", None, 99, D1, None),
            (4, "E", "F", 1, D1, None),
            (4, "E2", "F2", 1, D1, None),
        ],
        "customer_id bigint, first_name string, last_name string, geography_id bigint, registration_date date, phone bigint",
    )
    prod_b = spark.createDataFrame(
        [
            (10, "P10", 100.0, 50.0, 1, "Toys"),
            (11, "P11", None, 40.0, None, None),
            (12, "P12", -20.0, 10.0, 2, "Food"),
            (13, "P13", 10.0, None, 3, "Food"),
            (None, "PX", 1.0, 1.0, 1, "Toys"),
        ],
        "product_id bigint, product_name string, price double, cost double, supplier_id bigint, category string",
    )
    geo = silver.geography_silver(geo_b)
    return geo, silver.dim_customer(cust_b, geo), silver.product_silver(prod_b)


@pytest.fixture(scope="module")
def fact(spark, dims):
    _, cust, prod = dims
    orders = spark.createDataFrame(
        [
            (1, 1, 10, 2, 100.0, 0.1, 5.0, D1),
            (2, None, 11, None, None, None, None, None),
            (3, 3, 12, 1, 30.0, 1.5, 1.0, D1),
            (4, 2, 99, 1, 10.0, -0.1, 1.0, D1),
            (5, 4, 10, 1, 100.0, 0.0, 0.0, D1),
            (6, 1, 13, 1, 10.0, 0.0, 0.0, D1),
        ],
        "order_id bigint, customer_id bigint, product_id bigint, quantity bigint, unit_price double, "
        "discount double, shipping_cost double, order_date date",
    )
    return silver.orders_silver(orders, prod, cust, as_of=AS_OF)


def test_geography_silver(dims):
    rows = dims[0].collect()
    assert len(rows) == 1 and rows[0].postal_code == "12345"


def test_dim_customer_defaults(dims):
    rows = {r.customer_id: r for r in dims[1].collect() if r.customer_id != 4}
    assert set(rows) == {1, 2, 3}  # NULL id dropped
    assert rows[1].full_name == "A B" and rows[1].country == "USA"
    assert rows[2].full_name == "" and rows[2].geography_id == 0
    assert (rows[2].country, rows[2].state, rows[2].city) == ("Unknown",) * 3
    assert rows[2].registration_date == dt.date(2020, 1, 1)
    assert rows[3].country == "Unknown" and rows[3].geography_id == 99


def test_product_silver_imputation(dims):
    rows = {r.product_id: r for r in dims[2].collect()}
    assert None not in rows
    assert rows[11].price == 60.0 and rows[11].category == "UNKNOWN" and rows[11].supplier_id == 0
    assert rows[10].profit_margin_pct == 50.0
    assert rows[12].price == -20.0 and rows[12].profit_margin_pct == 0.0


def test_orders_silver_defaults_after_joins(fact):
    rows = fact.collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.order_id, []).append(r)
    assert len(by_id[5]) == 2  # duplicated customer fans out
    o2 = by_id[2][0]
    assert o2.customer_id == 0 and o2.full_name is None and o2.country is None  # NULL key: no match
    assert o2.quantity == 1 and o2.unit_price == 60.0 and o2.discount == 0.0 and o2.shipping_cost == 0.0
    assert o2.order_date == AS_OF
    assert by_id[3][0].discount == 1.0  # capped from above
    assert by_id[4][0].discount == -0.1  # negative passes
    assert by_id[4][0].product_name is None and by_id[4][0].country == "Unknown"


def test_enriched_and_gold(fact):
    enr = gold.orders_enriched(fact)
    rows = {r.order_id: r for r in enr.filter("order_id <> 5").collect()}
    assert rows[1].total_amount == pytest.approx(180.0) and rows[1].profit == pytest.approx(90.0)
    assert rows[6].profit is None  # NULL cost
    assert (rows[1].year, rows[1].month, rows[1].quarter, rows[1].month_name) == (2024, 1, 1, "Jan")

    geo = {(r.country, r.state, r.city): r for r in gold.sales_by_geography(enr).collect()}
    assert (None, None, None) in geo and ("Unknown", "Unknown", "Unknown") in geo

    cat = gold.sales_by_category(enr).collect()
    assert sum(r.revenue_share_pct for r in cat) == pytest.approx(100.0)

    cust = {r.customer_id: r for r in gold.customer_analytics(enr, as_of=AS_OF).collect()}
    assert 0 in cust  # sentinel customer forms a group
    assert cust[1].days_since_first_order == (AS_OF - D1).days

    by_date = gold.sales_by_date(enr).collect()
    assert sum(r.unique_customers for r in by_date if r.order_date == AS_OF) == 1


def test_unique_customers_counts_sentinel(fact):
    enr = gold.orders_enriched(fact)
    r = gold.monthly_sales_trend(enr.filter(F.col("order_date") == AS_OF)).first()
    assert r.unique_customers == 1 and r.total_orders == 1


def test_dense_rank_matches_the_literal_window(spark):
    values = [5, 3, 5, None, 1, 3, 9, 9, 0, None, 2, 7, 7, 7, 4] * 7 + [0] * 200  # ties, NULLs and a hot value
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "k int, v double")
    literal = F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last()))
    want = {r.k: r.r for r in df.withColumn("r", literal).collect()}
    for partitions in (1, 4, 50):
        assert {r.k: r.r for r in dense_rank_desc(df, "v", "r", partitions).collect()} == want
    assert want[6] == 1 and want[3] == max(want.values())  # NULL ranks last
    assert dense_rank_desc(df.limit(0), "v", "r").collect() == []


def test_zero_grand_total_gives_null_share(spark, dims):
    _, cust, prod = dims
    orders = spark.createDataFrame(
        [(1, 1, 10, 0, 100.0, 0.0, 0.0, D1), (2, 1, 12, 0, 10.0, 0.0, 0.0, D1)],
        "order_id bigint, customer_id bigint, product_id bigint, quantity bigint, unit_price double, "
        "discount double, shipping_cost double, order_date date",
    )
    enr = gold.orders_enriched(silver.orders_silver(orders, prod, cust, as_of=AS_OF))
    rows = gold.sales_by_category(enr).collect()
    assert rows and all(r.revenue_share_pct is None and r.profit_margin_pct == 0.0 for r in rows)
