"""Silver: cleaned dimensions and the enriched order fact.

The dimension functions are row-wise (plus a left join for the customer
dimension), so they run on streams as well as on batches. The order fact
is a stream-static left join: the streaming (or batch) fact side against
snapshots of the product and customer dimensions.

Join strategy: plain equi left joins, chosen by Spark. A dimension read
from a written table whose size in bytes lies under the broadcast threshold
is broadcast; any other is a sort-merge join, which AQE turns into a
broadcast join where the dimension proves small at run time, and whose
skewed fact partitions (e.g. one customer holding a third of all orders)
AQE splits into several tasks. No job runs while the plan is being built.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.config import DEFAULT_REGISTRATION_DATE
from retailflow.functions import (
    as_of_date,
    date_or,
    default_to,
    full_name,
    normalize_postal,
    num,
    ratio_pct,
)
from retailflow.operators.bronze import AUDIT_COLUMNS

# Defaults for missing attributes, the factor that imputes a
# missing price from the cost, and the upper cap of a discount.
UNKNOWN_PLACE = "Unknown"
UNKNOWN_CATEGORY = "UNKNOWN"
PRICE_PER_COST = "1.5"
DISCOUNT_CAP = "1.0"

# The output columns of the customer dimension and of the
# order fact, in order.
CUSTOMER_COLUMNS = (
    "customer_id", "full_name", "first_name", "last_name",
    "geography_id", "country", "state", "city",
    "registration_date", "phone",
)

ORDER_COLUMNS = (
    "order_id", "order_date", "customer_id", "product_id",
    "quantity", "unit_price", "discount", "shipping_cost",
    "product_name", "category", "price", "cost",
    "full_name", "country", "state", "city",
)


def geography_silver(bronze: DataFrame, updated: Column | None = None) -> DataFrame:
    """Drop rows without id, normalise postal codes, stamp the update."""
    return (
        bronze.drop(*AUDIT_COLUMNS)
        .filter(F.col("geography_id").isNotNull())
        .withColumns(
            {
                "postal_code": normalize_postal("postal_code"),
                "updated_timestamp": F.current_timestamp() if updated is None else updated,
            }
        )
    )


def product_silver(bronze: DataFrame) -> DataFrame:
    """Drop rows without id; a missing price is imputed as cost * 1.5
    (a negative price is kept); defaults for category and supplier; margin
    % is 0.0 unless the price is positive."""
    price = F.when(F.col("price").isNull(), F.col("cost") * num(PRICE_PER_COST)).otherwise(F.col("price"))
    return (
        bronze.drop(*AUDIT_COLUMNS)
        .filter(F.col("product_id").isNotNull())
        .withColumns(
            {
                "price": price,
                "category": default_to("category", UNKNOWN_CATEGORY),
                "supplier_id": default_to("supplier_id", F.lit(0).cast("long")),
                "profit_margin_pct": ratio_pct(price - F.col("cost"), price),
            }
        )
    )


def dim_customer(
    bronze: DataFrame,
    geography: DataFrame,
    default_registration: date = DEFAULT_REGISTRATION_DATE,
) -> DataFrame:
    """Customers with an id, left-joined to geography on geography_id;
    'Unknown' place for a missing geography, 0 for a missing geography id,
    a default registration date, and ``full_name``."""
    customers = (
        bronze.drop(*AUDIT_COLUMNS)
        .filter(F.col("customer_id").isNotNull())
        .select("customer_id", "first_name", "last_name", "geography_id", "registration_date", "phone")
    )
    geo = geography.select("geography_id", "country", "state", "city")
    out = {
        "customer_id": F.col("customer_id"),
        "full_name": full_name("first_name", "last_name"),
        "first_name": F.col("first_name"),
        "last_name": F.col("last_name"),
        "geography_id": default_to("geography_id", F.lit(0).cast("long")),
        "country": default_to("country", UNKNOWN_PLACE),
        "state": default_to("state", UNKNOWN_PLACE),
        "city": default_to("city", UNKNOWN_PLACE),
        "registration_date": date_or("registration_date", default_registration),
        "phone": F.col("phone"),
    }
    return customers.join(geo, on="geography_id", how="left").select(
        *[out[c].alias(c) for c in CUSTOMER_COLUMNS]
    )


def orders_silver(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    as_of: date | None = None,
    join_hint: str | None = None,
    products_last: bool = False,
) -> DataFrame:
    """The order fact enriched with product and customer attributes.

    Defaults are applied *after* the joins: a NULL key never matches, so its
    dimension columns stay NULL, and only then becomes 0. ``unit_price``
    falls back to the (possibly imputed) product price; the discount is
    capped at 1 from above only; an unreadable order date becomes
    ``as_of`` (``current_date()`` when not given). ``join_hint`` asks for a
    join strategy of the dimensions (``merge``: both sides are shuffled);
    ``products_last`` joins customers first, which gives the same rows and
    spares shuffling the product columns where the places are not wanted.
    """
    facts = orders.drop(*AUDIT_COLUMNS)
    prod = products.drop(*AUDIT_COLUMNS).select("product_id", "product_name", "category", "price", "cost")
    cust = customers.select("customer_id", "full_name", "country", "state", "city")
    if join_hint:
        prod, cust = prod.hint(join_hint), cust.hint(join_hint)
    dimensions = {"customer_id": cust, "product_id": prod} if products_last else {"product_id": prod, "customer_id": cust}
    enriched = facts
    for key, dimension in dimensions.items():
        enriched = enriched.join(dimension, on=key, how="left")
    defaults = {
        "quantity": default_to("quantity", F.lit(1).cast("long")),
        "unit_price": F.coalesce(F.col("unit_price"), F.col("price")),
        "discount": F.least(default_to("discount", num("0.0")), num(DISCOUNT_CAP)),
        "shipping_cost": default_to("shipping_cost", num("0.0")),
        "order_date": F.coalesce(F.col("order_date"), as_of_date(as_of)),
        "customer_id": default_to("customer_id", F.lit(0).cast("long")),
        "product_id": default_to("product_id", F.lit(0).cast("long")),
    }
    return enriched.select(*[defaults[c].alias(c) if c in defaults else F.col(c) for c in ORDER_COLUMNS])
