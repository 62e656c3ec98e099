"""The pipeline as a Spark Declarative Pipelines definition file.

List this file in a pipeline spec and run it with ``spark-pipelines run``
(which needs a Spark Connect server; not exercised in this repository's
tests beyond registering the datasets). Each dataset is one of the
DataFrame functions of ``retailflow.operators``; names, comments and
properties come from ``plans.pipeline.DATASETS``.

Settings (Spark conf):

* ``retailflow.source`` - raw-zone root holding ``geographies.csv``,
  ``customers/``, ``products/``, ``orders/`` and ``json/orders/``;
* ``retailflow.as_of`` - optional fixed date (``yyyy-MM-dd``) used in place
  of ``current_date()``;
* ``retailflow.rules.orders_bronze_demo3`` and ``..._silver_demo3`` - optional
  quality rules, a JSON list such as ``[{"name": "valid_order_id",
  "condition": "order_id IS NOT NULL", "action": "drop"}]``.

Query functions only build plans: the runner forbids actions while the
graph is defined, so the lineage cut of the range-parallel product rank is a
dataset of its own (``product_revenue_ranges``, over ``product_sales``).
"""

from __future__ import annotations

import json
from datetime import date

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from retailflow.operators import bronze, gold, json_orders, silver
from retailflow.operators.expectations import Expectation, apply_expectations
from retailflow.operators.ranking import in_ranges, ranked
from retailflow.plans.pipeline import BY_NAME
from retailflow.sources import files
from retailflow.sources.landing import Landing


def _spark() -> SparkSession:
    return SparkSession.active()


def _landing() -> Landing:
    return Landing(_spark().conf.get("retailflow.source"))


def _as_of() -> date | None:
    v = _spark().conf.get("retailflow.as_of", None)
    return date.fromisoformat(v) if v else None


def _meta(name: str) -> dict:
    d = BY_NAME[name]
    return {"name": name, "comment": d.comment, "table_properties": dict(d.properties)}


def _internal(name: str, comment: str) -> dict:
    return {"name": name, "comment": comment, "table_properties": {"quality": "gold"}}


# ---- geography (batch reference data) ---------------------------------------


@dp.materialized_view(**_meta("geography_bronze_v1"))
def geography_bronze_v1() -> DataFrame:
    return bronze.geography_bronze(files.read_geographies(_spark(), _landing().geographies))


@dp.materialized_view(**_meta("geography_silver"))
def geography_silver() -> DataFrame:
    return silver.geography_silver(_spark().read.table("geography_bronze_v1"))


# ---- products ------------------------------------------------------------------


@dp.table(**_meta("product_bronze_v1"))
def product_bronze_v1() -> DataFrame:
    return bronze.product_bronze(files.read_products(_spark(), _landing().products, stream=True))


@dp.table(**_meta("product_silver_v2"))
def product_silver_v2() -> DataFrame:
    return silver.product_silver(_spark().readStream.table("product_bronze_v1"))


# ---- customers -----------------------------------------------------------------


@dp.table(**_meta("customer_bronze_v1"))
def customer_bronze_v1() -> DataFrame:
    return bronze.customer_bronze(files.read_customers(_spark(), _landing().customers, stream=True))


@dp.table(**_meta("dim_customer_silver_v2"))
def dim_customer_silver_v2() -> DataFrame:
    spark = _spark()
    return silver.dim_customer(
        spark.readStream.table("customer_bronze_v1"), spark.read.table("geography_silver")
    )


# ---- orders --------------------------------------------------------------------


@dp.table(**_meta("orders_bronze_v1"))
def orders_bronze_v1() -> DataFrame:
    return bronze.orders_bronze(files.read_orders(_spark(), _landing().orders, stream=True))


@dp.table(**_meta("orders_silver"))
def orders_silver() -> DataFrame:
    spark = _spark()
    return silver.orders_silver(
        spark.readStream.table("orders_bronze_v1"),
        spark.read.table("product_silver_v2"),
        spark.read.table("dim_customer_silver_v2"),
        as_of=_as_of(),
    )


# ---- gold ----------------------------------------------------------------------


@dp.materialized_view(**_meta("gold_orders_enriched"))
def gold_orders_enriched() -> DataFrame:
    return gold.orders_enriched(_spark().read.table("orders_silver"))


def _enriched() -> DataFrame:
    return _spark().read.table("gold_orders_enriched")


@dp.materialized_view(**_meta("sales_by_date"))
def sales_by_date() -> DataFrame:
    return gold.sales_by_date(_enriched(), sort=False)


@dp.materialized_view(**_meta("sales_by_category"))
def sales_by_category() -> DataFrame:
    return gold.sales_by_category(_enriched(), sort=False)


@dp.materialized_view(**_meta("sales_by_geography"))
def sales_by_geography() -> DataFrame:
    return gold.sales_by_geography(_enriched(), sort=False)


@dp.materialized_view(**_meta("customer_analytics"))
def customer_analytics() -> DataFrame:
    return gold.customer_analytics(_enriched(), as_of=_as_of(), sort=False)


@dp.materialized_view(**_internal("product_sales", "Per-product totals before ranking"))
def product_sales() -> DataFrame:
    return gold.product_sales(_enriched())


@dp.materialized_view(**_internal("product_revenue_ranges", "Per-product totals with the number of their revenue range"))
def product_revenue_ranges() -> DataFrame:
    return in_ranges(_spark().read.table("product_sales"), "total_revenue", gold.PRODUCT_KEY)


@dp.materialized_view(**_meta("product_performance"))
def product_performance() -> DataFrame:
    rows = ranked(_spark().read.table("product_revenue_ranges"), "total_revenue", "product_rank")
    return gold.product_performance_of(rows, sort=False)


@dp.materialized_view(**_meta("monthly_sales_trend"))
def monthly_sales_trend() -> DataFrame:
    return gold.monthly_sales_trend(_enriched(), sort=False)


# ---- JSON orders -----------------------------------------------------------------


def _rules(dataset: str) -> tuple[Expectation, ...]:
    """The rules that the conf ``retailflow.rules.<dataset>`` gives."""
    given = json.loads(_spark().conf.get(f"retailflow.rules.{dataset}", "[]"))
    return tuple(Expectation(r["name"], r["condition"], r.get("action", "warn")) for r in given)


@dp.table(**_meta("orders_bronze_demo3"))
def orders_bronze_demo3() -> DataFrame:
    raw = files.read_json_records(_spark(), _landing().json_source, stream=True)
    return apply_expectations(json_orders.json_orders_bronze(raw), _rules("orders_bronze_demo3"))


@dp.table(**_meta("orders_silver_demo3"))
def orders_silver_demo3() -> DataFrame:
    silver_rows = json_orders.json_orders_silver(_spark().readStream.table("orders_bronze_demo3"))
    return apply_expectations(silver_rows, _rules("orders_silver_demo3"))


@dp.materialized_view(**_meta("orders_by_date_gold_demo3"))
def orders_by_date_gold_demo3() -> DataFrame:
    return json_orders.orders_by_date(_spark().read.table("orders_silver_demo3"))
