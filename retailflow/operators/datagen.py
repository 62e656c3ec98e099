"""Distributed generator of realistic dirty retail data.

Every value is a pure function of the row's id, a seed and the column's
name: a uniform number is 52 bits of the md5 of the three. So the output
does not depend on partitioning or on which executor computes a row (a lost
task recomputes the same rows), any row count works without repeating -
ids come from ``spark.range(n)`` or from an existing table - and plain SQL
can compute the same values, which is how the generated rows are checked.
Money is drawn as whole cents.

Faults are injected per row with the stated probability (so their counts
are within sampling tolerance of the target rate, not exact).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Value lists and ranges of the generated data.
CATEGORIES = ("Electronics", "Clothing", "Food", "Books", "Toys", "Home", "Sports", "Beauty")
FIRST_NAMES = ("John", "Jane", "Mike", "Sarah", "David", "Emily", "Chris", "Lisa", "Tom", "Amy")
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones",
    "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
)
STATES = ("CA", "NY", "TX", "FL", "IL")
COUNTRY_SPLIT = (("USA", 0.6), ("Canada", 0.2), ("Mexico", 0.2))
REGISTRATION_START, REGISTRATION_DAYS = date(2020, 1, 1), 1460
ORDER_START, ORDER_DAYS = date(2023, 1, 1), 730
DEFAULT_SEED = 42

# Fault rates.
GEO_POSTAL_NULL = 0.10
PRODUCT_NEGATIVE_PRICE, PRODUCT_CATEGORY_NULL, PRODUCT_SUPPLIER_NULL = 0.05, 0.08, 0.03
CUSTOMER_BAD_DATE, CUSTOMER_PHONE_NULL, CUSTOMER_GEO_NULL = 0.10, 0.05, 0.03
ORDER_BAD_DATE, ORDER_NEGATIVE_QTY, ORDER_BIG_DISCOUNT = 0.15, 0.02, 0.01
ORDER_DISCOUNT_NULL, ORDER_SHIPPING_NULL, ORDER_CUSTOMER_NULL = 0.04, 0.02, 0.01

# Bits of the md5 that a uniform number uses: all of a double's precision.
_BITS = 52


def uniform(id_col: Column, seed: int, salt: str) -> Column:
    """A U[0,1) double from the row id; independent per ``salt``."""
    text = F.concat_ws(":", id_col.cast("string"), F.lit(str(seed)), F.lit(salt))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")
    return bits.cast("double") / F.lit(float(1 << _BITS))


def between(u: Column, lo: float, hi: float) -> Column:
    """A money amount in [lo, hi], drawn in whole cents."""
    lo_c, hi_c = round(lo * 100), round(hi * 100)
    cents = F.lit(lo_c) + F.floor(u * F.lit(float(hi_c - lo_c + 1)))
    return cents.cast("double") / F.lit(100.0)


def randint(u: Column, lo: int, hi: int | Column) -> Column:
    """Integer in [lo, hi] inclusive."""
    return (F.lit(lo) + F.floor(u * F.lit(hi - lo + 1))).cast("long")


def pick(u: Column, values: tuple[str, ...]) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * F.lit(len(values))) + 1).cast("int"))


def ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1..n, generated in parallel."""
    return spark.range(1, n + 1).withColumnRenamed("id", "gen_id")


def geographies(seeds: DataFrame, n_total: int | Column, seed: int = DEFAULT_SEED) -> DataFrame:
    """G1: country by id band (60% / 20% / 20% of ``n_total`` ids), states
    cycling, postal codes with 10% NULL."""
    gid = F.col("gen_id")
    frac = (gid - 1).cast("double") / F.greatest(F.lit(n_total), F.lit(1)).cast("double")
    country, upper = None, 0.0
    for name, share in COUNTRY_SPLIT[:-1]:
        upper += share
        country = (F.when if country is None else country.when)(frac < F.lit(upper), F.lit(name))
    country = country.otherwise(F.lit(COUNTRY_SPLIT[-1][0]))
    postal = randint(uniform(gid, seed, "postal"), 10000, 99999).cast("string")
    return seeds.select(
        gid.alias("geography_id"),
        country.alias("country"),
        F.element_at(F.array(*[F.lit(s) for s in STATES]), (F.pmod(gid - 1, F.lit(len(STATES))) + 1).cast("int")).alias("state"),
        F.concat(F.lit("City_"), gid.cast("string")).alias("city"),
        F.when(uniform(gid, seed, "postal_null") < GEO_POSTAL_NULL, F.lit(None).cast("string"))
        .otherwise(postal)
        .alias("postal_code"),
    )


def products(seeds: DataFrame, n_suppliers: int | Column = 50, seed: int = DEFAULT_SEED) -> DataFrame:
    """Price U(10,500), cost U(5,400), 8 categories; 5% negative prices,
    8% NULL category, 3% NULL supplier (double column, as pandas writes it)."""
    gid = F.col("gen_id")
    price = between(uniform(gid, seed, "price"), 10, 500)
    return seeds.select(
        gid.alias("product_id"),
        F.concat(F.lit("Product_"), gid.cast("string")).alias("product_name"),
        F.when(uniform(gid, seed, "neg_price") < PRODUCT_NEGATIVE_PRICE, -price).otherwise(price).alias("price"),
        between(uniform(gid, seed, "cost"), 5, 400).alias("cost"),
        F.when(uniform(gid, seed, "supplier_null") < PRODUCT_SUPPLIER_NULL, F.lit(None).cast("double"))
        .otherwise(randint(uniform(gid, seed, "supplier"), 1, n_suppliers).cast("double"))
        .alias("supplier_id"),
        F.when(uniform(gid, seed, "category_null") < PRODUCT_CATEGORY_NULL, F.lit(None).cast("string"))
        .otherwise(pick(uniform(gid, seed, "category"), CATEGORIES))
        .alias("category"),
    )


def _date_text(d: Column, u: Column, bad_rate: float, layouts: tuple[str, ...], invalid: str) -> Column:
    """ISO text, except for ``bad_rate`` of rows, split evenly over the
    other layouts and an invalid marker."""
    slots = len(layouts) + 1
    slot = F.floor(u / F.lit(bad_rate) * F.lit(slots)).cast("int")
    expr = F.when(u >= F.lit(bad_rate), F.date_format(d, "yyyy-MM-dd"))
    for i, layout in enumerate(layouts):
        expr = expr.when(slot == i, F.date_format(d, layout))
    return expr.otherwise(F.lit(invalid))


def customers(seeds: DataFrame, n_geographies: int | Column = 50, seed: int = DEFAULT_SEED) -> DataFrame:
    """Names from fixed lists, ``ddd-ddd-dddd`` phones (5% NULL),
    geography 1..n (3% NULL, double column), registration dates over four
    years, 10% of them as MM/dd/yyyy, dd-MM-yyyy or ``invalid_date``."""
    gid = F.col("gen_id")
    u = lambda salt: uniform(gid, seed, salt)
    reg = F.date_add(F.lit(REGISTRATION_START), randint(u("reg"), 0, REGISTRATION_DAYS).cast("int"))
    phone = F.format_string(
        "%d-%d-%d", randint(u("ph1"), 100, 999), randint(u("ph2"), 100, 999), randint(u("ph3"), 1000, 9999)
    )
    return seeds.select(
        gid.alias("customer_id"),
        pick(u("first"), FIRST_NAMES).alias("first_name"),
        pick(u("last"), LAST_NAMES).alias("last_name"),
        F.concat(F.lit("customer_"), gid.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(u("phone_null") < CUSTOMER_PHONE_NULL, F.lit(None).cast("string")).otherwise(phone).alias("phone"),
        F.when(u("geo_null") < CUSTOMER_GEO_NULL, F.lit(None).cast("double"))
        .otherwise(randint(u("geo"), 1, n_geographies).cast("double"))
        .alias("geography_id"),
        _date_text(reg, u("reg_fmt"), CUSTOMER_BAD_DATE, ("MM/dd/yyyy", "dd-MM-yyyy"), "invalid_date").alias(
            "registration_date"
        ),
    )


def orders(
    seeds: DataFrame, n_customers: int | Column = 10000, n_products: int | Column = 1000, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Orders over two years with 15% of dates in other layouts or
    invalid, 2% negative quantities, 1% discounts in [1, 2), 4% NULL
    discounts, 2% NULL shipping, 1% NULL customers (double column)."""
    gid = F.col("gen_id")
    u = lambda salt: uniform(gid, seed, salt)
    od = F.date_add(F.lit(ORDER_START), randint(u("date"), 0, ORDER_DAYS).cast("int"))
    qty = randint(u("qty"), 1, 10)
    disc = F.when(u("big_disc") < ORDER_BIG_DISCOUNT, between(u("big_disc_v"), 1.0, 2.0)).otherwise(
        between(u("disc"), 0.0, 0.3)
    )
    return seeds.select(
        gid.alias("order_id"),
        F.when(u("cust_null") < ORDER_CUSTOMER_NULL, F.lit(None).cast("double"))
        .otherwise(randint(u("cust"), 1, n_customers).cast("double"))
        .alias("customer_id"),
        randint(u("prod"), 1, n_products).alias("product_id"),
        _date_text(od, u("date_fmt"), ORDER_BAD_DATE, ("MM/dd/yyyy", "dd-MM-yyyy", "yyyyMMdd"), "invalid").alias(
            "order_date"
        ),
        F.when(u("neg_qty") < ORDER_NEGATIVE_QTY, -qty).otherwise(qty).alias("quantity"),
        between(u("price"), 10, 500).alias("unit_price"),
        F.when(u("disc_null") < ORDER_DISCOUNT_NULL, F.lit(None).cast("double")).otherwise(disc).alias("discount"),
        F.when(u("ship_null") < ORDER_SHIPPING_NULL, F.lit(None).cast("double"))
        .otherwise(between(u("ship"), 5, 50))
        .alias("shipping_cost"),
    )


def fault_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Faults per generated table and column (G5-G8): missing values, negative
    amounts, discounts of 1 and more, dates that are not in the ISO layout."""
    iso = r"^\d{4}-\d{2}-\d{2}$"
    faults = {
        "null": lambda c: c.isNull(),
        "negative": lambda c: c < 0,
        "discount": lambda c: c >= 1,
        "date": lambda c: ~c.rlike(iso),
    }
    watched = {
        "geographies": {"postal_code": ("null",)},
        "products": {"price": ("negative",), "category": ("null",), "supplier_id": ("null",)},
        "customers": {"registration_date": ("date",), "phone": ("null",), "geography_id": ("null",)},
        "orders": {
            "order_date": ("date",), "quantity": ("negative",), "discount": ("null", "discount"),
            "shipping_cost": ("null",), "customer_id": ("null",),
        },
    }
    out = None
    for name, df in tables.items():
        checks = [(c, f) for c, kinds in watched[name].items() for f in kinds]
        sums = df.agg(*(F.count(F.when(faults[f](F.col(c)), F.lit(1))).alias(f"{c}:{f}") for c, f in checks))
        rows = F.explode(
            F.array(
                *(
                    F.struct(F.lit(c).alias("column_name"), F.lit(f).alias("fault"), F.col(f"`{c}:{f}`").alias("faults"))
                    for c, f in checks
                )
            )
        )
        part = sums.select(F.lit(name).alias("dataset"), rows.alias("r")).select("dataset", "r.*")
        out = part if out is None else out.unionByName(part)
    return out


def summary(tables: dict[str, DataFrame], id_columns: dict[str, str]) -> DataFrame:
    """Rows and distinct ids per generated table, as one DataFrame
    (one small aggregate per table, unioned)."""
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(F.col(id_columns[name])).alias("distinct_ids"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
