"""Gold: business tables over the enriched order fact.

All six tables read ``orders_enriched``; the pipeline runner writes it once
and the six aggregates read it back, instead of re-deriving it six times.

Every aggregate is a hash aggregate with a map-side partial step, so a hot
group key (the 0 "unknown customer" sentinel, one best-selling product) is
combined inside each map task before the shuffle. Exact distinct counts use
Spark's Expand rewrite: the shuffle is on (group, distinct value), so a hot
group is spread over many tasks there too; over a stored table they are
counted apart from the other aggregates (``operators/distinct.py``). Money is summed in its input
type (exact for DECIMAL) and returned as DOUBLE.

Sorted outputs break ties on the group key: the requested order is kept,
the order is deterministic, and a value shared by many rows (say a third of
all customers with the same lifetime value) is spread over several range
partitions instead of landing in one sort task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.functions import as_of_date, mean_of, money_out, num, ratio_pct, segment, share_pct
from retailflow.operators.distinct import agg_with_distinct, ranged_counts, value_counts
from retailflow.operators.ranking import dense_rank_desc


def _amounts() -> dict[str, Column]:
    one_minus_disc = num("1.0") - F.col("discount")
    return {
        "total_amount": F.col("quantity") * F.col("unit_price") * one_minus_disc,
        "discount_amount": F.col("quantity") * F.col("unit_price") * F.col("discount"),
        "profit": (F.col("unit_price") - F.col("cost")) * F.col("quantity") * one_minus_disc,
    }


def orders_enriched(silver: DataFrame) -> DataFrame:
    """Amounts, profit and calendar parts, computed once."""
    d = F.col("order_date")
    return silver.withColumns(
        {
            **_amounts(),
            "year": F.year(d),
            "month": F.month(d),
            "quarter": F.quarter(d),
            "month_name": F.monthname(d),
        }
    )


def _finish(df: DataFrame, money: tuple[str, ...], extra: dict | None = None) -> DataFrame:
    """Margin %, any extra derived columns and money as double, in one
    projection (derived columns read the aggregated values)."""
    cols = {"profit_margin_pct": ratio_pct("total_profit", "total_revenue"), **(extra or {})}
    cols.update({n: money_out(n) for n in money})
    return df.withColumns(cols)


def _lead(df: DataFrame, lead: dict) -> DataFrame:
    """``lead`` columns first (kept or derived from the group keys), then
    the rest of ``df``."""
    return df.select(*[c.alias(n) for n, c in lead.items()], *[c for c in df.columns if c not in lead])


def _grouped(
    df: DataFrame, keys: tuple[str, ...], aggregates: list, distinct: dict[str, str], bitmaps: bool = False, stored: bool = False, **other_counts
) -> DataFrame:
    """One row per group. ``bitmaps`` counts the ``distinct`` columns without
    expanding the rows (``operators/distinct.py``): for a stored input, which
    is then read once more for each of them, with dense ids. ``stored`` does
    so by the different (group, value) rows, whatever the ids, or as
    ``other_counts`` says for a count."""
    if stored:
        return agg_with_distinct(df, keys, aggregates, distinct, value_counts, **other_counts)
    if bitmaps:
        return agg_with_distinct(df, keys, aggregates, distinct)
    return df.groupBy(*keys).agg(*aggregates, *(F.count_distinct(c).alias(name) for name, c in distinct.items()))


def sales_by_date(enriched: DataFrame, sort: bool = True, bitmaps: bool = False, stored: bool = False) -> DataFrame:
    """Daily totals, ordered by date. Grouped on the date alone (year,
    month and quarter follow from it and are derived after the aggregate),
    so the shuffles carry one key instead of four."""
    d = F.col("order_date")
    out = (
        _grouped(
            enriched,
            ("order_date",),
            [
                F.count("order_id").alias("total_orders"),
                F.sum("quantity").alias("total_quantity"),
                F.sum("total_amount").alias("total_revenue"),
                F.sum("discount_amount").alias("total_discount"),
                F.sum("shipping_cost").alias("total_shipping"),
                F.sum("profit").alias("total_profit"),
                mean_of("total_amount").alias("avg_order_value"),
            ],
            {"unique_customers": "customer_id", "unique_products": "product_id"},
            bitmaps,
            stored,
        )
        .transform(_finish, ("total_revenue", "total_discount", "total_shipping", "total_profit"))
        .transform(_lead, {"order_date": d, "year": F.year(d), "month": F.month(d), "quarter": F.quarter(d)})
    )
    return out.orderBy("order_date") if sort else out


def sales_by_category(enriched: DataFrame, sort: bool = True, bitmaps: bool = False, stored: bool = False) -> DataFrame:
    """Per category, with each category's share of all revenue.

    The grand total is a window sum over the aggregated rows (one per
    category), so the plan stays lazy: no driver round trip while the
    plan is being built."""
    out = (
        _grouped(
            enriched,
            ("category",),
            [
                F.count("order_id").alias("total_orders"),
                F.sum("quantity").alias("total_quantity_sold"),
                F.sum("total_amount").alias("total_revenue"),
                F.sum("profit").alias("total_profit"),
                mean_of("total_amount").alias("avg_order_value"),
                mean_of("unit_price").alias("avg_unit_price"),
            ],
            {"unique_products": "product_id", "unique_customers": "customer_id"},
            bitmaps,
            stored,
        )
        .transform(
            _finish,
            ("total_revenue", "total_profit"),
            {"revenue_share_pct": share_pct("total_revenue", F.sum("total_revenue").over(Window.partitionBy()))},
        )
    )
    return out.orderBy(F.desc("total_revenue"), "category") if sort else out


def sales_by_geography(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Per country/state/city (NULL place = order without customer)."""
    out = (
        _grouped(
            enriched,
            ("country", "state", "city"),
            [
                F.count("order_id").alias("total_orders"),
                F.sum("quantity").alias("total_quantity_sold"),
                F.sum("total_amount").alias("total_revenue"),
                F.sum("profit").alias("total_profit"),
                mean_of("total_amount").alias("avg_order_value"),
            ],
            {"unique_customers": "customer_id", "unique_products": "product_id"},
            stored=stored,
        )
        .transform(_finish, ("total_revenue", "total_profit"))
    )
    return out.orderBy(F.desc("total_revenue"), "country", "state", "city") if sort else out


def customer_analytics(enriched: DataFrame, as_of: date | None = None, sort: bool = True, stored: bool = False) -> DataFrame:
    """Lifetime metrics and segment per customer; day counts are taken
    from ``as_of`` (``current_date()`` when not given). ``stored`` counts the
    products of each customer by ranges of customers: the enriched rows are
    not expanded, and only customer and product are shuffled row by row."""
    today = as_of_date(as_of)
    out = (
        _grouped(
            enriched,
            ("customer_id", "full_name", "country", "state", "city"),
            [
                F.count("order_id").alias("total_orders"),
                F.sum("quantity").alias("total_items_purchased"),
                F.sum("total_amount").alias("lifetime_value"),
                mean_of("total_amount").alias("avg_order_value"),
                F.min("order_date").alias("first_order_date"),
                F.max("order_date").alias("last_order_date"),
            ],
            {"unique_products_purchased": "product_id", "unique_categories_purchased": "category"},
            stored=stored,
            unique_products_purchased=ranged_counts,
        )
        .withColumns(
            {
                "days_since_first_order": F.datediff(today, F.col("first_order_date")),
                "days_since_last_order": F.datediff(today, F.col("last_order_date")),
                "customer_segment": segment("lifetime_value"),
                "lifetime_value": money_out("lifetime_value"),
            }
        )
    )
    return out.orderBy(F.desc("lifetime_value"), "customer_id", "full_name") if sort else out


PRODUCT_KEY = ("product_id", "product_name", "category")


def product_sales(enriched: DataFrame, stored: bool = False) -> DataFrame:
    """D14 before the rank: per-product totals (revenue still exact).
    ``stored`` shuffles the rows once, by ranges of product and customer: a
    product lies in one range, or in the few over which its many customers
    are spread, so about one row a product is shuffled for the totals. The
    ranges are sampled, so the input is read twice. Amounts are wide decimals
    and are taken from the columns that they follow from, after the shuffle."""
    if stored:
        ordered = F.when(F.col("order_id").isNotNull(), F.lit(1)).alias("order_id")  # only whether it is there counts
        rows = enriched.select(*PRODUCT_KEY, "customer_id", ordered, "quantity", "unit_price", "discount", "cost")
        enriched = rows.repartitionByRange("product_id", "customer_id").withColumns(_amounts())
    return (
        enriched.groupBy(*PRODUCT_KEY)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("total_amount").alias("total_revenue"),
            F.sum("profit").alias("total_profit"),
            mean_of("unit_price").alias("avg_selling_price"),
            F.min("unit_price").alias("min_price"),
            F.max("unit_price").alias("max_price"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .transform(
            _finish,
            ("total_profit", "min_price", "max_price"),
            {
                "avg_quantity_per_order": F.try_divide(
                    F.col("total_quantity_sold").cast("double"), F.col("total_orders").cast("double")
                )
            },
        )
    )


def product_performance_of(ranked: DataFrame, sort: bool = True) -> DataFrame:
    """D14 after the rank: revenue exposed as double, ordered by revenue."""
    out = ranked.withColumn("total_revenue", money_out("total_revenue"))
    return out.orderBy(F.desc("total_revenue"), "product_id") if sort else out


def product_performance(enriched: DataFrame, sort: bool = True, stored: bool = False) -> DataFrame:
    """Per product, with a dense rank by revenue (ties share a rank);
    the rank is taken on the exact revenue (see ``operators/ranking.py``)."""
    ranked = dense_rank_desc(product_sales(enriched, stored), "total_revenue", "product_rank", ties=PRODUCT_KEY)
    return product_performance_of(ranked, sort=sort)


def monthly_sales_trend(enriched: DataFrame, sort: bool = True, bitmaps: bool = False, stored: bool = False) -> DataFrame:
    """Per calendar month. Grouped on (year, month); quarter and month
    name follow from them and are derived after the aggregate."""
    first_day = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    out = (
        _grouped(
            enriched,
            ("year", "month"),
            [
                F.count("order_id").alias("total_orders"),
                F.sum("quantity").alias("total_quantity"),
                F.sum("total_amount").alias("total_revenue"),
                F.sum("profit").alias("total_profit"),
                mean_of("total_amount").alias("avg_order_value"),
            ],
            {"unique_customers": "customer_id", "unique_products": "product_id"},
            bitmaps,
            stored,
        )
        .transform(_finish, ("total_revenue", "total_profit"))
        .transform(
            _lead,
            {
                "year": F.col("year"),
                "month": F.col("month"),
                "quarter": F.quarter(first_day),
                "month_name": F.monthname(first_day),
            },
        )
    )
    return out.orderBy("year", "month") if sort else out


GOLD_TABLES = {
    "sales_by_date": sales_by_date,
    "sales_by_category": sales_by_category,
    "sales_by_geography": sales_by_geography,
    "customer_analytics": customer_analytics,
    "product_performance": product_performance,
    "monthly_sales_trend": monthly_sales_trend,
}
