"""Bronze: raw rows plus audit columns and light type repair.

Each function takes the raw DataFrame (batch or streaming) and is purely
row-wise, so it runs inside one stage with no shuffle. ``audit=False``
skips the audit columns (used when the source is not a file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.functions import digits_to_long, parse_mixed_date, whole_number
from retailflow.sources.files import with_audit


def _audit(df: DataFrame, audit: bool, source=None) -> DataFrame:
    return with_audit(df, source) if audit else df


def _date_last(df: DataFrame, name: str) -> DataFrame:
    """The text column ``name`` replaced by its date, as the last column."""
    others = [c for c in df.columns if c != name]
    return df.select(*others, parse_mixed_date(name).alias(name))


def customer_bronze(raw: DataFrame, audit: bool = True, keep_text: bool = False) -> DataFrame:
    """Audit columns, phone digits -> long, 4-layout registration date
    (last). ``keep_text`` keeps the ids as they came as ``<name>_text``, which
    shows what an id that became NULL was."""
    if keep_text:
        raw = raw.withColumns({f"{c}_text": F.col(c) for c in ("customer_id", "geography_id")})
    return _date_last(_audit(raw, audit), "registration_date").withColumns(
        {
            "phone": digits_to_long("phone"),
            "customer_id": whole_number("customer_id"),
            "geography_id": whole_number("geography_id"),
        }
    )


def orders_bronze(raw: DataFrame, audit: bool = True) -> DataFrame:
    """D3: audit columns, 4-layout order date (last). The month folder that
    the files lie in is no column of the orders."""
    return _date_last(_audit(raw, audit).drop("year_month"), "order_date").withColumns(
        {
            "order_id": whole_number("order_id"),
            "customer_id": whole_number("customer_id"),
            "product_id": whole_number("product_id"),
        }
    )


def product_bronze(raw: DataFrame, audit: bool = True) -> DataFrame:
    """Audit columns only (ids repaired to long)."""
    return _audit(raw, audit).withColumns({"product_id": whole_number("product_id"), "supplier_id": whole_number("supplier_id")})


def geography_bronze(raw: DataFrame, audit: bool = True, source_name: str = "geographies.csv") -> DataFrame:
    """Batch single file, the source recorded as a constant name."""
    return _audit(raw, audit, F.lit(source_name)).withColumns({"geography_id": whole_number("geography_id")})


AUDIT_COLUMNS = ("processing_time", "source_file")
