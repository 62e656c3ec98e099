"""Dataset declarations and the end-to-end run (K1, K2, K5, K6).

The datasets are listed in dependency order with their comment and table
properties. ``run_pipeline`` runs the streaming bronze/silver tables, then
the batch gold layer: ``gold_orders_enriched`` is written once and the six
gold tables read it back, so the joins and derived columns are computed
once, not six times. Optionally the tables are registered in the catalog
under a schema with their comment and properties.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType

from retailflow.config import freed_shuffles
from retailflow.operators import gold, json_orders
from retailflow.sources.landing import Landing
from retailflow.streaming.runner import (
    Warehouse,
    current_version,
    refresh_table,
    run_concurrently,
    run_json_streams,
    run_retail_streams,
)


@dataclass(frozen=True)
class Dataset:
    name: str
    kind: str  # "stream" (append, incremental) or "batch" (full refresh)
    comment: str
    properties: dict[str, str] = field(default_factory=dict)


def _p(quality: str, **extra: str) -> dict[str, str]:
    return {"quality": quality, **extra}


# Names, comments and properties of the declared datasets.
DATASETS: tuple[Dataset, ...] = (
    Dataset("geography_bronze_v1", "batch", "Raw geography reference data (single CSV)", _p("bronze")),
    Dataset("geography_silver", "batch", "Cleaned geography reference data", _p("silver", table_type="reference")),
    Dataset("product_bronze_v1", "stream", "Raw product data ingested from Parquet files", _p("bronze")),
    Dataset("product_silver_v2", "stream", "Cleaned and enriched product dimension", _p("silver")),
    Dataset("customer_bronze_v1", "stream", "Raw customer data ingested from CSV files", _p("bronze")),
    Dataset("dim_customer_silver_v2", "stream", "Cleaned & enriched customer dimension", _p("silver")),
    Dataset("orders_bronze_v1", "stream", "Raw orders data ingested from Parquet files", _p("bronze")),
    Dataset("orders_silver", "stream", "Order fact table enriched with dimensions", _p("silver", table_type="fact")),
    Dataset("gold_orders_enriched", "batch", "Enriched base for gold layer calculations"),
    Dataset("sales_by_date", "batch", "Daily sales summary with key metrics", _p("gold")),
    Dataset("sales_by_category", "batch", "Sales performance aggregated by product category", _p("gold")),
    Dataset("sales_by_geography", "batch", "Sales performance by country/state/city", _p("gold")),
    Dataset("customer_analytics", "batch", "Customer-level lifetime metrics and segmentation", _p("gold")),
    Dataset("product_performance", "batch", "Product-level sales and profitability metrics", _p("gold")),
    Dataset("monthly_sales_trend", "batch", "Monthly aggregated sales trends", _p("gold")),
    Dataset("orders_bronze_demo3", "stream", "Ingest raw JSON order files with data quality checks", _p("bronze")),
    Dataset("orders_silver_demo3", "stream", "Cleaned and transformed orders data with quality checks", _p("silver")),
    Dataset("orders_by_date_gold_demo3", "batch", "Daily order aggregations", _p("gold")),
)

BY_NAME = {d.name: d for d in DATASETS}

#: Gold tables that are built at a time: their shuffles are on disk together.
GOLD_AT_ONCE = 3

# The order in which a gold table is stored: files of disjoint ranges of these keys (O1, O2).
STORED_ORDER = {
    "sales_by_date": ("order_date",),
    "sales_by_category": ("total_revenue desc", "category"),
    "sales_by_geography": ("total_revenue desc", "country", "state", "city"),
    "customer_analytics": ("lifetime_value desc", "customer_id", "full_name"),
    "product_performance": ("total_revenue desc", "product_id"),
    "monthly_sales_trend": ("year", "month"),
}


def sort_keys(names: tuple[str, ...]) -> tuple[Column, ...]:
    keys = (n.split(" ") for n in names)
    return tuple(F.desc(k[0]) if len(k) > 1 else F.asc(k[0]) for k in keys)


def run_gold(spark: SparkSession, wh: Warehouse, as_of: date | None = None) -> None:
    """Batch gold layer over the streamed silver fact (T5), each table stored
    in its order. Distinct ids are counted apart from the other aggregates."""
    refresh_table(gold.orders_enriched(spark.read.parquet(wh.table("orders_silver"))), wh, "gold_orders_enriched")
    enriched = spark.read.parquet(wh.table("gold_orders_enriched"))

    more = {"customer_analytics": {"as_of": as_of}}

    def build(name, fn):
        def step() -> None:  # built in its own thread: the rank inputs are written there too
            df = fn(enriched, sort=False, stored=True, **more.get(name, {}))
            refresh_table(df, wh, name, cluster_by=sort_keys(STORED_ORDER[name]))

        return step

    # the six tables only read the enriched base: independent jobs
    run_concurrently(*[build(name, fn) for name, fn in gold.GOLD_TABLES.items()], at_once=GOLD_AT_ONCE)


def run_json_gold(spark: SparkSession, wh: Warehouse) -> None:
    silver = spark.read.parquet(wh.table("orders_silver_demo3"))
    refresh_table(json_orders.orders_by_date(silver), wh, "orders_by_date_gold_demo3")


def run_pipeline(
    spark: SparkSession,
    landing: Landing,
    wh: Warehouse,
    as_of: date | None = None,
    money: DataType = DoubleType(),
    order_date_default: date | None = None,
    json_rules: tuple = ((), ()),
) -> None:
    """Everything in dependency order: streams first, then the batch gold.
    The retail and the JSON pipelines share nothing and run side by side.
    ``as_of`` stands for today, ``order_date_default`` (else ``as_of``) for
    the date of an order whose date cannot be read."""

    def retail() -> None:
        run_retail_streams(spark, landing, wh, as_of=order_date_default or as_of, money=money)
        run_gold(spark, wh, as_of=as_of)

    def json_orders_pipeline() -> None:
        run_json_streams(spark, landing.json_source, wh, bronze_rules=json_rules[0], silver_rules=json_rules[1])
        run_json_gold(spark, wh)

    with freed_shuffles(spark):
        run_concurrently(retail, json_orders_pipeline)


# Property names Spark keeps for itself; such a declared property is stored
# under ``dataset.<name>`` in the catalog.
RESERVED_PROPERTIES = ("table_type", "provider", "location", "owner", "comment", "external")


def catalog_properties(d: Dataset) -> dict[str, str]:
    return {(f"dataset.{k}" if k in RESERVED_PROPERTIES else k): v for k, v in d.properties.items()}


def _quoted(text: str) -> str:
    """``text`` as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(text: str) -> str:
    """``text`` as an SQL identifier."""
    return "`" + text.replace("`", "``") + "`"


def register_tables(spark: SparkSession, wh: Warehouse, schema: str, use: bool = False) -> list[str]:
    """K5, K6: create the schema and register every written table in it,
    with its comment and properties; ``use=True`` also makes it the current
    schema (``USE SCHEMA``)."""
    quoted_schema = _name(schema)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted_schema} LOCATION {_quoted(f'{wh.root}/catalog/{schema}.db')}")
    if use:
        spark.catalog.setCurrentDatabase(schema)
    done = []
    for d in DATASETS:
        if (version := current_version(spark, wh, d.name)) is None:
            continue  # not written in this run
        path = wh.kept(d.name) if d.kind == "stream" else f"{wh.folder(d.name)}/{version}"
        full = f"{schema}.{d.name}"
        spark.sql(f"DROP TABLE IF EXISTS {quoted_schema}.{d.name}")
        props = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in catalog_properties(d).items())
        # A streaming table is all its batch folders.
        options = "OPTIONS (recursiveFileLookup 'true')" if d.kind == "stream" else ""
        spark.sql(
            f"CREATE TABLE {quoted_schema}.{d.name} USING parquet {options} LOCATION {_quoted(path)} COMMENT {_quoted(d.comment)}"
            + (f" TBLPROPERTIES ({props})" if props else "")
        )
        done.append(full)
    return done
