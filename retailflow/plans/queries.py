"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given test tables (whole tables, no sampling or
filtering) and runs the pipeline step it is named after on the raw inputs
derived from them. The batch queries chain the DataFrame functions
directly; the ``stream_*`` queries land the raw inputs as files and run the
real Structured Streaming chain over them (see ``retailflow.streaming``).

Audit columns (ingest time, file path) depend on when and where a run
happens, so the compared queries leave them out; the ``provenance_*``
queries compare what does not depend on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from retailflow.config import DEFAULT_AS_OF, DEFAULT_ORDER_DATE, freed_shuffles, run_folder
from retailflow.functions import digits_to_long, normalize_postal, parse_mixed_date, whole_number
from retailflow.operators import bronze, gold, json_orders, silver
from retailflow.operators.expectations import (
    VALID_ORDER_ID_DROP,
    VALID_ORDER_ID_FAIL,
    VALID_TIMESTAMP_DROP,
)
from retailflow.schemas import MONEY_DECIMAL
from retailflow.sources import testdata
from retailflow.operators import datagen
from retailflow.sources import files
from retailflow.sources.landing import (
    Landing,
    land_test_feeds,
    write_by_category,
    write_by_month,
    write_csv_files,
    write_lines,
)
from retailflow.streaming.runner import (
    Warehouse,
    expectation_results,
    quarantined,
    read_all_columns,
    run_customer_bronze,
    run_json_streams,
    run_orders_bronze,
    run_retail_streams,
)

Query = Callable[[SparkSession, str], DataFrame]


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal money -> double for output."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(casts) if casts else df


# ---- the chain over the derived raw inputs --------------------------------


def geography_silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.raw(spark, sf_dir, "geographies")
    return silver.geography_silver(bronze.geography_bronze(raw, audit=False))


def product_silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.product_silver(bronze.product_bronze(testdata.raw(spark, sf_dir, "products"), audit=False))


def dim_customer_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = bronze.customer_bronze(testdata.raw(spark, sf_dir, "customers"), audit=False)
    return silver.dim_customer(cust, geography_silver_of(spark, sf_dir))


def orders_silver_of(
    spark: SparkSession, sf_dir: str, as_of: date = DEFAULT_ORDER_DATE, join_hint: str | None = None, products_last: bool = False
) -> DataFrame:
    orders = bronze.orders_bronze(testdata.raw(spark, sf_dir, "orders"), audit=False)
    return silver.orders_silver(
        orders, product_silver_of(spark, sf_dir), dim_customer_of(spark, sf_dir), as_of, join_hint, products_last
    )


def enriched_of(spark: SparkSession, sf_dir: str, as_of: date = DEFAULT_ORDER_DATE) -> DataFrame:
    return gold.orders_enriched(orders_silver_of(spark, sf_dir, as_of))


def json_bronze_of(spark: SparkSession, sf_dir: str, expectations=()) -> DataFrame:
    return json_orders.json_orders_bronze(
        testdata.raw(spark, sf_dir, "json_orders"), audit=False, expectations=expectations
    )


def json_silver_of(spark: SparkSession, sf_dir: str, expectations=()) -> DataFrame:
    return json_orders.json_orders_silver(json_bronze_of(spark, sf_dir), expectations=expectations)


# ---- registered batch queries ----------------------------------------------


def q_geography_bronze(spark, sf_dir):
    return bronze.geography_bronze(testdata.raw(spark, sf_dir, "geographies"), audit=False)


def q_geography_silver(spark, sf_dir):
    return geography_silver_of(spark, sf_dir).drop("updated_timestamp")


def q_product_bronze(spark, sf_dir):
    return as_doubles(bronze.product_bronze(testdata.raw(spark, sf_dir, "products"), audit=False))


def q_product_silver(spark, sf_dir):
    return as_doubles(product_silver_of(spark, sf_dir))


def q_customer_bronze(spark, sf_dir):
    return bronze.customer_bronze(testdata.raw(spark, sf_dir, "customers"), audit=False)


def q_dim_customer(spark, sf_dir):
    return dim_customer_of(spark, sf_dir)


def q_orders_bronze(spark, sf_dir):
    return as_doubles(bronze.orders_bronze(testdata.raw(spark, sf_dir, "orders"), audit=False))


def q_orders_silver(spark, sf_dir):
    return as_doubles(orders_silver_of(spark, sf_dir))


def q_orders_silver_shuffle_join(spark, sf_dir):
    """The order fact with both dimension joins as shuffle (sort-merge)
    joins: the path a dimension too large to broadcast takes."""
    return as_doubles(orders_silver_of(spark, sf_dir, join_hint="merge"))


def q_orders_enriched(spark, sf_dir):
    return as_doubles(enriched_of(spark, sf_dir))


def q_sales_by_date(spark, sf_dir):
    return gold.sales_by_date(enriched_of(spark, sf_dir))


def q_sales_by_category(spark, sf_dir):
    return gold.sales_by_category(enriched_of(spark, sf_dir))


def q_sales_by_geography(spark, sf_dir):
    return gold.sales_by_geography(enriched_of(spark, sf_dir))


def q_customer_analytics(spark, sf_dir):
    return gold.customer_analytics(enriched_of(spark, sf_dir), as_of=DEFAULT_AS_OF)


def q_product_performance(spark, sf_dir):
    silver_rows = orders_silver_of(spark, sf_dir, products_last=True)  # the product columns are shuffled once less
    return gold.product_performance(gold.orders_enriched(silver_rows))


def q_monthly_sales_trend(spark, sf_dir):
    return gold.monthly_sales_trend(enriched_of(spark, sf_dir))


def q_json_orders_bronze(spark, sf_dir):
    return json_bronze_of(spark, sf_dir)


def q_json_orders_silver(spark, sf_dir):
    return json_silver_of(spark, sf_dir)


def q_orders_by_date(spark, sf_dir):
    return json_orders.orders_by_date(json_silver_of(spark, sf_dir))


def q_orders_by_date_sql(spark, sf_dir):
    return json_orders.orders_by_date_sql(spark, json_silver_of(spark, sf_dir))


def q_expect_drop_null_id(spark, sf_dir):
    return json_bronze_of(spark, sf_dir, expectations=(VALID_ORDER_ID_DROP,))


def q_expect_drop_old_ts(spark, sf_dir):
    return json_silver_of(spark, sf_dir, expectations=(VALID_TIMESTAMP_DROP,))


def q_expect_fail_passes(spark, sf_dir):
    """Bronze drops NULL ids, so the silver FAIL rule sees none and passes."""
    bronze_ok = json_bronze_of(spark, sf_dir, expectations=(VALID_ORDER_ID_DROP,))
    return json_orders.json_orders_silver(bronze_ok, expectations=(VALID_ORDER_ID_FAIL,))


def q_clean_order_dates(spark, sf_dir):
    """Every raw order-date text next to the date it parses to."""
    raw = testdata.raw(spark, sf_dir, "orders")
    return raw.select("order_id", F.col("order_date").alias("order_date_text"), parse_mixed_date("order_date").alias("order_date"))


def q_clean_phone(spark, sf_dir):
    """Raw phone text next to its digits as a long."""
    raw = testdata.raw(spark, sf_dir, "customers")
    return raw.select("customer_id", F.col("phone").alias("phone_text"), digits_to_long("phone").alias("phone"))


def q_clean_postal(spark, sf_dir):
    """Raw postal code next to its normalised form."""
    raw = testdata.raw(spark, sf_dir, "geographies")
    return raw.select("geography_id", F.col("postal_code").alias("postal_text"), normalize_postal("postal_code").alias("postal_code"))


BATCH_QUERIES: dict[str, Query] = {
    "clean_order_dates": q_clean_order_dates,
    "clean_phone": q_clean_phone,
    "clean_postal": q_clean_postal,
    "geography_bronze": q_geography_bronze,
    "geography_silver": q_geography_silver,
    "product_bronze": q_product_bronze,
    "product_silver": q_product_silver,
    "customer_bronze": q_customer_bronze,
    "dim_customer": q_dim_customer,
    "orders_bronze": q_orders_bronze,
    "orders_silver": q_orders_silver,
    "orders_silver_shuffle_join": q_orders_silver_shuffle_join,
    "orders_enriched": q_orders_enriched,
    "sales_by_date": q_sales_by_date,
    "sales_by_category": q_sales_by_category,
    "sales_by_geography": q_sales_by_geography,
    "customer_analytics": q_customer_analytics,
    "product_performance": q_product_performance,
    "monthly_sales_trend": q_monthly_sales_trend,
    "json_orders_bronze": q_json_orders_bronze,
    "json_orders_silver": q_json_orders_silver,
    "orders_by_date": q_orders_by_date,
    "orders_by_date_sql": q_orders_by_date_sql,
    "expect_drop_null_id": q_expect_drop_null_id,
    "expect_drop_old_ts": q_expect_drop_old_ts,
    "expect_fail_passes": q_expect_fail_passes,
}


# ---- registered streaming queries --------------------------------------------

_STREAM_RUNS: dict[tuple[SparkSession, str], tuple[Landing, Warehouse]] = {}


def streamed_run(spark: SparkSession, sf_dir: str) -> tuple[Landing, Warehouse]:
    """Land the raw feeds derived from ``sf_dir`` as files in a fresh folder
    on shared storage and run every streaming table over them with
    ``availableNow``. Done once per session and input folder; the stream
    and round-trip queries below read the resulting files and tables."""
    key = (spark, sf_dir)
    if key not in _STREAM_RUNS:
        root = run_folder(spark, "stream")
        wh = Warehouse(f"{root}/warehouse")
        with freed_shuffles(spark):
            land = land_test_feeds(spark, sf_dir, f"{root}/landing")
            run_retail_streams(spark, land, wh, as_of=DEFAULT_ORDER_DATE, money=MONEY_DECIMAL)
            run_json_streams(spark, land.json_source, wh)
        _STREAM_RUNS[key] = (land, wh)
    return _STREAM_RUNS[key]


def streamed_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return streamed_run(spark, sf_dir)[1]


def _streamed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(streamed_warehouse(spark, sf_dir).table(table))


def q_stream_product_silver(spark, sf_dir):
    return as_doubles(_streamed(spark, sf_dir, "product_silver_v2"))


def q_stream_dim_customer(spark, sf_dir):
    return _streamed(spark, sf_dir, "dim_customer_silver_v2")


def q_stream_orders_silver(spark, sf_dir):
    return as_doubles(_streamed(spark, sf_dir, "orders_silver"))


def q_stream_sales_by_category(spark, sf_dir):
    """T5: batch gold over the streamed silver fact."""
    return gold.sales_by_category(gold.orders_enriched(_streamed(spark, sf_dir, "orders_silver")))


def q_stream_json_orders_silver(spark, sf_dir):
    return _streamed(spark, sf_dir, "orders_silver_demo3")


def q_stream_orders_by_date(spark, sf_dir):
    return json_orders.orders_by_date(_streamed(spark, sf_dir, "orders_silver_demo3"))


def q_provenance_order_months(spark, sf_dir):
    """Rows of the streamed order bronze per month folder, taken from the
    recorded path of the file that each came from."""
    month = F.regexp_extract("source_file", r"/year_month=([^/]+)/[^/]+\.parquet$", 1)
    orders = _streamed(spark, sf_dir, "orders_bronze_v1")
    return orders.groupBy(month.alias("month_folder")).agg(F.count(F.lit(1)).alias("row_count"))


def q_provenance_audit(spark, sf_dir):
    """S7-S10 per bronze table: rows, rows without an ingest time or with one
    that lies ahead, and rows whose source is not of the expected form."""
    tables = {
        "customer_bronze_v1": r"/customers/[^/]+\.csv$",
        "geography_bronze_v1": r"^geographies\.csv$",
        "orders_bronze_demo3": r"^[^/]+\.json$",
        "orders_bronze_v1": r"/orders/year_month=[^/]+/[^/]+\.parquet$",
        "product_bronze_v1": r"/products/category=[^/]+/[^/]+\.parquet$",
    }
    out = None
    for name, form in tables.items():
        df = _streamed(spark, sf_dir, name).agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(F.when(F.coalesce(F.col("processing_time") > F.current_timestamp(), F.lit(True)), 1)).alias("bad_times"),
            F.count(F.when(~F.coalesce(F.col("source_file").rlike(form), F.lit(False)), 1)).alias("bad_sources"),
        )
        out = df if out is None else out.unionByName(df)
    return out


def q_catalog(spark, sf_dir):
    """K5, K6: the pipeline's tables registered in a schema of their own, read
    back from the catalog: name, comment, quality and row count."""
    from retailflow.plans.pipeline import register_tables

    _pipeline_table(spark, sf_dir, "sales_by_date")
    schema = f"retailflow_{uuid.uuid4().hex[:12]}"
    out = None
    for full in register_tables(spark, streamed_warehouse(spark, sf_dir), schema):
        name = full.split(".")[1]
        comment = spark.catalog.getTable(full).description
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
        df = spark.table(full).agg(
            F.lit(name).alias("dataset"),
            F.lit(comment).alias("comment"),
            F.lit(properties.get("quality")).cast("string").alias("quality"),
            F.count(F.lit(1)).alias("row_count"),
        )
        out = df if out is None else out.unionByName(df)
    return out


_GOLD_RUNS: set[tuple[SparkSession, str]] = set()


def _pipeline_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A gold table as the pipeline runner writes it: the batch gold layer
    (enriched base written once, the six tables as concurrent jobs) over the
    streamed silver tables."""
    from retailflow.plans.pipeline import run_gold, run_json_gold

    key = (spark, sf_dir)
    wh = streamed_warehouse(spark, sf_dir)
    if key not in _GOLD_RUNS:
        with freed_shuffles(spark):
            run_gold(spark, wh, as_of=DEFAULT_AS_OF)
            run_json_gold(spark, wh)
        _GOLD_RUNS.add(key)
    return spark.read.parquet(wh.table(table))


def _pipeline_query(table: str) -> Query:
    def q(spark, sf_dir):
        return _pipeline_table(spark, sf_dir, table)

    q.__name__ = f"q_pipeline_{table}"
    return q


STREAM_QUERIES: dict[str, Query] = {
    "stream_product_silver": q_stream_product_silver,
    "stream_dim_customer": q_stream_dim_customer,
    "stream_orders_silver": q_stream_orders_silver,
    "stream_sales_by_category": q_stream_sales_by_category,
    "stream_json_orders_silver": q_stream_json_orders_silver,
    "stream_orders_by_date": q_stream_orders_by_date,
    "provenance_order_months": q_provenance_order_months,
    "provenance_audit": q_provenance_audit,
    "catalog": q_catalog,
    **{
        f"pipeline_{t}": _pipeline_query(t)
        for t in (
            "sales_by_date",
            "sales_by_category",
            "sales_by_geography",
            "customer_analytics",
            "product_performance",
            "monthly_sales_trend",
        )
    },
    "pipeline_orders_by_date": _pipeline_query("orders_by_date_gold_demo3"),
}


# ---- raw-zone layouts read back (K7-K10 written, S1-S5 read in batch) ------


def q_roundtrip_geographies_csv(spark, sf_dir):
    raw = files.read_geographies(spark, streamed_run(spark, sf_dir)[0].geographies)
    return raw.withColumn("geography_id", whole_number("geography_id"))


def q_roundtrip_customers_csv(spark, sf_dir):
    return files.read_customers(spark, streamed_run(spark, sf_dir)[0].customers, stream=False)


def q_roundtrip_products_by_category(spark, sf_dir):
    land = streamed_run(spark, sf_dir)[0]
    return as_doubles(files.read_products(spark, land.products, stream=False, money=MONEY_DECIMAL))


def q_roundtrip_orders_by_month(spark, sf_dir):
    land = streamed_run(spark, sf_dir)[0]
    return as_doubles(files.read_orders(spark, land.orders, stream=False, money=MONEY_DECIMAL))


def q_roundtrip_json_orders(spark, sf_dir):
    return files.read_json_orders(spark, streamed_run(spark, sf_dir)[0].json_source, stream=False)


# ---- generator (one row per row of a test table, under an id made from its key) ----


def _rows(spark: SparkSession, sf_dir: str, table: str) -> Column:
    """How many rows a table has, as a scalar subquery of the plan."""
    return testdata.load(spark, sf_dir, table).select(F.count(F.lit(1))).scalar()


def _line_id() -> Column:
    """A whole number from the columns that tell order lines apart: 52 bits of their md5."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    text = F.concat_ws(":", *(F.col(k).cast("long").cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def _generated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated row per row of the matching test table, under an id that
    its key gives; the sizes of the id domains are counts of tables."""
    table, id_ = {
        "geographies": ("nation", F.col("n_nationkey") + 1),
        "products": ("part", F.col("p_partkey") + 1),
        "customers": ("customer", F.col("c_custkey") + 1),
        "orders": ("lineitem", _line_id()),
    }[name]
    ids = testdata.load(spark, sf_dir, table).select(id_.alias("gen_id"))
    if name == "geographies":
        return datagen.geographies(ids, n_total=_rows(spark, sf_dir, "nation"))
    if name == "products":
        return datagen.products(ids, n_suppliers=_rows(spark, sf_dir, "supplier"))
    if name == "customers":
        return datagen.customers(ids, n_geographies=_rows(spark, sf_dir, "nation"))
    return datagen.orders(
        ids, n_customers=_rows(spark, sf_dir, "customer"), n_products=_rows(spark, sf_dir, "part")
    )


GENERATED = ("geographies", "products", "customers", "orders")


def q_datagen_geographies(spark, sf_dir):
    return _generated(spark, sf_dir, "geographies")


def q_datagen_products(spark, sf_dir):
    return _generated(spark, sf_dir, "products")


def q_datagen_customers(spark, sf_dir):
    return _generated(spark, sf_dir, "customers")


def q_datagen_orders(spark, sf_dir):
    return _generated(spark, sf_dir, "orders")


def q_datagen_summary(spark, sf_dir):
    ids = {"geographies": "geography_id", "products": "product_id", "customers": "customer_id", "orders": "order_id"}
    return datagen.summary({name: _generated(spark, sf_dir, name) for name in GENERATED}, ids)


def q_datagen_faults(spark, sf_dir):
    return datagen.fault_counts({name: _generated(spark, sf_dir, name) for name in GENERATED})


def q_datagen_layouts(spark, sf_dir):
    """Generated products and orders written in their raw-zone layouts (by
    category, by month) and read back through the stream-capable readers:
    rows per partition value."""
    root = run_folder(spark, "generated")
    write_by_category(_generated(spark, sf_dir, "products"), f"{root}/products")
    write_by_month(_generated(spark, sf_dir, "orders"), f"{root}/orders")
    products = files.read_products(spark, f"{root}/products", stream=False)
    orders = files.read_orders(spark, f"{root}/orders", stream=False)
    parts = [
        df.groupBy(F.col(key).alias("partition_value"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(id_).alias("distinct_ids"))
        .select(F.lit(name).alias("dataset"), "partition_value", "row_count", "distinct_ids")
        for name, df, key, id_ in (
            ("products", products, "category", "product_id"),
            ("orders", orders, "year_month", "order_id"),
        )
    ]
    return parts[0].unionByName(parts[1])


def q_customer_bronze_dirty(spark, sf_dir):
    """Customer feed with ids that are no numbers, landed as CSV and read
    back: every row is kept, with the text of its ids."""
    k = F.col("c_custkey")
    dirty = testdata.load(spark, sf_dir, "customer").select(
        F.when(k % 7 == 0, F.concat(F.lit("X"), k.cast("string")))
        .when(k % 7 == 1, F.concat(k.cast("string"), F.lit(".5")))
        .when(k % 7 == 2, F.concat(k.cast("string"), F.lit(".0")))
        .otherwise(k.cast("string"))
        .alias("customer_id"),
        F.lit("First").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("5551").alias("phone"),
        F.when(k % 5 == 0, "unknown").otherwise((F.col("c_nationkey") + 1).cast("double").cast("string")).alias("geography_id"),
        F.lit("2021-02-03").alias("registration_date"),
    )
    path = f"{run_folder(spark, 'dirty')}/customers"
    write_csv_files(dirty, path)
    return bronze.customer_bronze(files.read_customers(spark, path, stream=False), audit=False, keep_text=True)


def q_geography_bronze_by_header(spark, sf_dir):
    """The geography file with its columns in another order, one more
    column and ids that are no numbers, read by its header."""
    raw = testdata.raw(spark, sf_dir, "geographies")
    shuffled = raw.select(
        "city", "state", F.lower("state").alias("region_name"), "country",
        F.when(F.col("geography_id") % 5 == 0, F.concat(F.lit("X"), F.col("geography_id").cast("string")))
        .otherwise(F.col("geography_id").cast("double").cast("string")).alias("geography_id"),
        "postal_code",
    )
    path = f"{run_folder(spark, 'dirty')}/geographies.csv"
    write_csv_files(shuffled, path)
    read = files.read_geographies(spark, path)
    return bronze.geography_bronze(read.withColumn("geography_id_text", F.col("geography_id")), audit=False)


def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per event: ids that are text, numbers in quotes or
    missing, fields that no schema lists, times of all kinds, and lines that
    break off."""
    raw = testdata.raw_json_orders(spark, sf_dir, ("event_id",))
    k = F.col("event_id")

    def quoted(c: str):
        return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))

    order_id = (
        F.when(k % 7 == 0, F.concat(F.lit('"A-'), k.cast("string"), F.lit('"')))
        .when(k % 7 == 1, F.concat(F.lit('"'), k.cast("string"), F.lit('"')))
        .when(k % 7 == 2, "null")
        .otherwise(k.cast("string"))
    )
    extra = F.when(k % 3 == 0, F.concat(F.lit('"extra":{"rank":'), k.cast("string"), F.lit(',"tags":["a","b"]},'))).otherwise("")
    line = F.concat(
        F.lit('{"customer_id":'), F.coalesce(F.col("customer_id").cast("string"), F.lit("null")), F.lit(","), extra,
        F.lit('"notifications":'), F.coalesce(quoted("notifications"), F.lit("null")), F.lit(',"order_id":'), order_id,
        F.lit(',"order_timestamp":'), quoted("order_timestamp"), F.lit("}"),
    )
    broken = F.expr("left(line, length(line) - 3)")
    return raw.select(k, line.alias("line")).select(F.when(k % 11 == 0, broken).otherwise(F.col("line")).alias("line"))


def q_json_orders_dirty(spark, sf_dir):
    """The dirty JSON feed landed as files and streamed: no
    row and no field is lost."""
    root = run_folder(spark, "dirty")
    write_lines(_json_lines(spark, sf_dir), f"{root}/json/orders")
    wh = Warehouse(f"{root}/warehouse")
    run_json_streams(spark, f"{root}/json", wh)
    return spark.read.parquet(wh.table("orders_bronze_demo3")).select(
        "order_id", "order_id_text", "customer_id", "notifications",
        json_orders.utc_timestamp("order_timestamp").alias("order_timestamp"),
        F.try_variant_get("record", "$.extra.rank", "long").alias("extra_rank"),
        F.to_json("record").alias("record"), "broken_line",
    )


JSON_RULES = ((VALID_ORDER_ID_DROP,), (VALID_TIMESTAMP_DROP,))


def q_expectation_results(spark, sf_dir):
    """Q1, Q2: what the rules found in the streamed JSON pipeline, from the
    results tables of its micro-batches, beside the rows in quarantine."""
    land, _ = streamed_run(spark, sf_dir)
    wh = Warehouse(f"{run_folder(spark, 'rules')}/warehouse")
    run_json_streams(spark, land.json_source, wh, *JSON_RULES)
    results = expectation_results(spark, wh).groupBy("dataset", "rule", "condition", "action")
    results = results.agg(F.sum("rows_seen").alias("rows_seen"), F.sum("violations").alias("violations"))
    rows = None
    for dataset, rules in zip(("orders_bronze_demo3", "orders_silver_demo3"), JSON_RULES):
        dropped = quarantined(spark, wh, dataset, rules).select(F.explode("violated_rules").alias("rule"))
        dropped = dropped.groupBy("rule").agg(F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("quarantined"))
        rows = dropped if rows is None else rows.unionByName(dropped)
    return results.join(rows, ["dataset", "rule"], "left")


def q_later_columns_customers(spark, sf_dir):
    """Two deliveries of customers, the second with its columns in
    another order and one more, streamed one after the other into one table."""
    root = run_folder(spark, "later")
    raw = testdata.raw(spark, sf_dir, "customers")
    odd = F.regexp_extract("email", "_([0-9]+)@", 1).cast("long") % 2 == 1
    wh = Warehouse(f"{root}/warehouse")
    write_csv_files(raw.where(~odd), f"{root}/customers")
    run_customer_bronze(spark, f"{root}/customers", wh)
    more = raw.where(odd).select(F.lower("last_name").alias("tier"), *reversed(raw.columns))
    write_csv_files(more, f"{root}/customers")
    run_customer_bronze(spark, f"{root}/customers", wh)
    return read_all_columns(spark, wh, "customer_bronze_v1").drop(*bronze.AUDIT_COLUMNS)


def q_later_columns_orders(spark, sf_dir):
    """Two deliveries of orders, the second with one more column."""
    root = run_folder(spark, "later")
    raw = testdata.raw(spark, sf_dir, "orders")
    odd = F.col("order_id") % 2 == 1
    wh = Warehouse(f"{root}/warehouse")
    write_by_month(raw.where(~odd), f"{root}/orders")
    run_orders_bronze(spark, f"{root}/orders", wh, MONEY_DECIMAL)
    more = raw.where(odd).withColumn("channel", F.concat(F.lit("channel "), (F.col("order_id") % 3).cast("string")))
    write_by_month(more, f"{root}/orders")
    run_orders_bronze(spark, f"{root}/orders", wh, MONEY_DECIMAL)
    return as_doubles(read_all_columns(spark, wh, "orders_bronze_v1").drop(*bronze.AUDIT_COLUMNS))


EXTRA_QUERIES: dict[str, Query] = {
    "geography_bronze_by_header": q_geography_bronze_by_header,
    "json_orders_dirty": q_json_orders_dirty,
    "expectation_results": q_expectation_results,
    "later_columns_customers": q_later_columns_customers,
    "later_columns_orders": q_later_columns_orders,
    "roundtrip_geographies_csv": q_roundtrip_geographies_csv,
    "roundtrip_customers_csv": q_roundtrip_customers_csv,
    "roundtrip_products_by_category": q_roundtrip_products_by_category,
    "roundtrip_orders_by_month": q_roundtrip_orders_by_month,
    "roundtrip_json_orders": q_roundtrip_json_orders,
    "customer_bronze_dirty": q_customer_bronze_dirty,
    "datagen_geographies": q_datagen_geographies,
    "datagen_products": q_datagen_products,
    "datagen_customers": q_datagen_customers,
    "datagen_orders": q_datagen_orders,
    "datagen_summary": q_datagen_summary,
    "datagen_faults": q_datagen_faults,
    "datagen_layouts": q_datagen_layouts,
}


def all_queries() -> dict[str, Query]:
    return {**BATCH_QUERIES, **STREAM_QUERIES, **EXTRA_QUERIES}
