"""Explicit schemas of the raw sources.

File streams need a schema up front, and inference would turn postal codes
into integers and lose leading zeros, so every source is declared here.
Money is double in the original retail files; the fixtures derived from the
test tables carry it as DECIMAL(18,2) so results can be compared exactly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY_DECIMAL = DecimalType(18, 2)


def _s(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


def geography_schema() -> StructType:
    return _s(
        ("geography_id", LongType()),
        ("country", StringType()),
        ("state", StringType()),
        ("city", StringType()),
        ("postal_code", StringType()),
    )


def product_schema(money: DataType = DoubleType()) -> StructType:
    """Products land partitioned by ``category`` (a directory column);
    ``supplier_id`` is double in the files because of injected NULLs."""
    return _s(
        ("product_id", LongType()),
        ("product_name", StringType()),
        ("price", money),
        ("cost", money),
        ("supplier_id", DoubleType()),
        ("category", StringType()),
    )


def customer_schema() -> StructType:
    """Customers land as CSV. Ids are read as text (``geography_id`` is
    written as ``12.0``), so an id that is no number is seen and not lost."""
    return _s(
        ("customer_id", StringType()),
        ("first_name", StringType()),
        ("last_name", StringType()),
        ("email", StringType()),
        ("phone", StringType()),
        ("geography_id", StringType()),
        ("registration_date", StringType()),
    )


def order_schema(money: DataType = DoubleType()) -> StructType:
    """Orders land as parquet; ``order_date`` is text in mixed formats."""
    return _s(
        ("order_id", LongType()),
        ("customer_id", DoubleType()),
        ("product_id", LongType()),
        ("order_date", StringType()),
        ("quantity", LongType()),
        ("unit_price", money),
        ("discount", money),
        ("shipping_cost", money),
    )


def json_order_schema() -> StructType:
    """JSON orders of the SQL pipeline (types are our choice)."""
    return _s(
        ("order_id", LongType()),
        ("order_timestamp", StringType()),
        ("customer_id", LongType()),
        ("notifications", StringType()),
    )
