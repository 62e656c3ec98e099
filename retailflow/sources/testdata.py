"""Raw retail inputs derived from the TPC-H-style test tables.

The original pipeline ingests dirty retail files (geographies, products,
customers, orders, JSON orders). Here those files are derived, row for row,
from the given tables, and the dirt is injected by arithmetic rules on the
keys instead of random sampling, so Spark and an SQL oracle produce the same
rows and every rule fires at a known rate. No row of any input is dropped:
orphan references are made by pointing an order at a key that does not
exist in the dimension (a negative id).

Keys start at 0 in the test tables and 0 is the pipeline's "unknown"
sentinel, so every key is shifted by +1.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# First registration date and the span of registration days.
REGISTRATION_START = date(2020, 1, 1)
REGISTRATION_DAYS = 1461


_LOADED: dict[tuple[SparkSession, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The inputs are read-only, so the DataFrame (file listing
    and footer schema) is built once per session and reused."""
    key = (spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    if key not in _LOADED:
        _LOADED[key] = spark.read.parquet(key[1])
    return _LOADED[key]


def money_from_cents(cents: Column) -> Column:
    """Integer cents -> DECIMAL(18,2), exact."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def cents(x: Column) -> Column:
    """Dollars held as double -> integer cents (round half away from zero)."""
    return F.round(x * F.lit(100.0)).cast("bigint")


def raw_geographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geography per nation: country = region, state = nation name."""
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.when(k == 24, F.lit(None)).otherwise(k + 1).cast("bigint").alias("geography_id"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("state"),
        F.concat(F.lit("City_"), k.cast("string")).alias("city"),
        F.when(k % 10 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" ab "), (k + 10000).cast("string"), F.lit(" ")))
        .alias("postal_code"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part: missing categories, missing and negative
    prices, missing suppliers."""
    p = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = money_from_cents(cents(F.col("p_retailprice")))
    return p.select(
        F.when(k % 150 == 149, F.lit(None)).otherwise(k + 1).cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(k % 40 == 8, F.lit(None).cast("decimal(18,2)"))
        .when(k % 20 == 1, -price)
        .otherwise(price)
        .alias("price"),
        money_from_cents(F.floor(F.col("p_retailprice") * F.lit(60.0)).cast("bigint")).alias("cost"),
        F.when(k % 33 == 2, F.lit(None).cast("double"))
        .otherwise((k % 50 + 1).cast("double"))
        .alias("supplier_id"),
        F.when(k % 12 == 5, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer per test customer: missing names, unreadable phones,
    missing geographies, registration dates in mixed formats."""
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    reg = F.date_add(F.lit(REGISTRATION_START), (k % REGISTRATION_DAYS).cast("int"))
    fmt = k % 30
    no_name = k % 90 == 4
    return c.select(
        F.when(k % 120 == 119, F.lit(None)).when(k % 100 == 70, k).otherwise(k + 1).cast("bigint").alias("customer_id"),
        F.when(no_name, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("First"), (k % 10).cast("string")))
        .alias("first_name"),
        F.when(no_name, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("last_name"),
        F.concat(F.lit("customer_"), (k + 1).cast("string"), F.lit("@example.com")).alias("email"),
        F.when(k % 20 == 6, F.lit(None).cast("string"))
        .when(k % 20 == 7, F.lit("n/a"))
        .otherwise(F.concat(F.lit("(555) "), (k + 1000000).cast("string")))
        .alias("phone"),
        F.when(k % 33 == 1, F.lit(None).cast("double"))
        .otherwise((F.col("c_nationkey") + 1).cast("double"))
        .alias("geography_id"),
        F.when(fmt == 0, F.date_format(reg, "MM/dd/yyyy"))
        .when(fmt == 1, F.date_format(reg, "dd-MM-yyyy"))
        .when(fmt == 2, F.lit("invalid_date"))
        .otherwise(F.date_format(reg, "yyyy-MM-dd"))
        .alias("registration_date"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order line per lineitem (joined to its order for customer and
    date): mixed date formats, missing and orphan keys, negative
    quantities, missing prices, over-range and missing discounts."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    k = F.col("l_orderkey")
    cust = F.col("o_custkey") + 1
    part = F.col("l_partkey") + 1
    od = F.col("o_orderdate")
    m = k % 20
    qty = F.col("l_quantity").cast("bigint")
    # orphan customers have few orders: low prices bring them into the lower segments
    cheapness = F.when(k % 150 == 149, 100.0).when(k % 150 == 74, 10.0).otherwise(1.0)
    return j.select(
        k.alias("order_id"),
        F.when(k % 100 == 7, F.lit(None).cast("double"))
        .when(k % 75 == 74, (-cust).cast("double"))
        .otherwise(cust.cast("double"))
        .alias("customer_id"),
        F.when(k % 50 == 49, -part).otherwise(part).cast("bigint").alias("product_id"),
        F.when(m == 0, F.date_format(od, "MM/dd/yyyy"))
        .when(m == 1, F.date_format(od, "dd-MM-yyyy"))
        .when(m == 2, F.date_format(od, "yyyyMMdd"))
        .when(m == 3, F.lit("invalid"))
        .otherwise(F.date_format(od, "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(k % 50 == 9, -qty).when(k % 70 == 21, F.lit(None)).otherwise(qty).cast("bigint").alias("quantity"),
        F.when((k % 200).isin(13, 149), F.lit(None).cast("decimal(18,2)"))
        .otherwise(
            money_from_cents(
                F.floor(F.col("l_extendedprice") * F.lit(100.0) / F.col("l_quantity") / cheapness).cast("bigint")
            )
        )
        .alias("unit_price"),
        F.when(k % 25 == 4, F.lit(None).cast("decimal(18,2)"))
        .when((k % 100 == 11) | (k % 200 == 99), F.lit(Decimal("1.50")).cast("decimal(18,2)"))
        .otherwise(money_from_cents(cents(F.col("l_discount"))))
        .alias("discount"),
        F.when(k % 50 == 17, F.lit(None).cast("decimal(18,2)"))
        .otherwise(money_from_cents(cents(F.col("l_tax") * F.lit(100.0))))
        .alias("shipping_cost"),
    )


def raw_json_orders(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON orders from the event table; some ids missing and some times
    long past (DROP-rule bait), times with an offset, as epoch seconds and
    milliseconds around 2021-12-25, as 14 digits, and unreadable. ``keep``
    names event columns to keep beside them."""
    e = load(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        F.when(k % 100 == 5, F.lit(None).cast("bigint")).otherwise(k + 1).alias("order_id"),
        F.when(k % 50 == 7, F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00")))
        .when(k % 50 == 8, (F.lit(1640390400) + (k - 500) * 600).cast("string"))
        .when(k % 50 == 9, F.lit("2019-06-01 12:00:00"))
        .when(k % 50 == 10, F.lit("not a time"))
        .when(k % 50 == 11, F.date_format(F.col("ts"), "yyyyMMddHHmmss"))
        .when(k % 50 == 12, ((F.lit(1640390400) + (k - 500) * 600) * 1000 + k % 1000).cast("string"))
        .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("order_timestamp"),
        F.col("user_id").alias("customer_id"),
        F.col("props").alias("notifications"),
        *keep,
    )


RAW_BUILDERS = {
    "geographies": raw_geographies,
    "products": raw_products,
    "customers": raw_customers,
    "orders": raw_orders,
    "json_orders": raw_json_orders,
}

_RAW: dict[tuple[SparkSession, str, str], DataFrame] = {}


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """The raw feed ``feed`` derived from ``sf_dir``; the plan is built once
    per session (the inputs are read-only), the data is read on each use."""
    key = (spark, sf_dir, feed)
    if key not in _RAW:
        _RAW[key] = RAW_BUILDERS[feed](spark, sf_dir)
    return _RAW[key]
