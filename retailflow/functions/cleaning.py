"""Column expressions for cleaning and KPI arithmetic.

All of them are built-in Spark expressions (no UDFs), so they stay inside
whole-stage codegen and behave the same in batch and streaming. They are
ANSI-safe: parsing and casting use the ``try_`` forms, so a bad value
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts tried in order; the first that parses wins.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyyMMdd")

# Lifetime-value thresholds of the customer segments.
SEGMENTS = (("VIP", 10000), ("Premium", 5000), ("Regular", 1000))
SEGMENT_DEFAULT = "New"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(value: str) -> Column:
    """A numeric literal that keeps DECIMAL inputs DECIMAL and DOUBLE inputs
    DOUBLE (``lit(1.5)`` would turn decimal money into double)."""
    return F.lit(Decimal(value))


def parse_mixed_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First layout that parses, else NULL."""
    c = _c(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def digits_to_long(c: Column | str) -> Column:
    """Keep digits only and read them as a long; empty -> NULL."""
    return F.regexp_replace(_c(c), "[^0-9]", "").try_cast("long")


def whole_number(c: Column | str) -> Column:
    """An id that may arrive as double (NULLs in pandas-written files), or as
    text of either -> bigint; NULL if it is no whole number."""
    c = _c(c)
    number = c.try_cast("double")
    return F.coalesce(c.try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))


def normalize_postal(c: Column | str) -> Column:
    """Trim, remove inner spaces, upper-case."""
    return F.upper(F.regexp_replace(F.trim(_c(c)), " ", ""))


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; NULL parts are skipped, both NULL gives '' (C7)."""
    return F.concat_ws(" ", _c(first), _c(last))


def default_to(c: Column | str, value) -> Column:
    """COALESCE with a literal, a column or an expression."""
    return F.coalesce(_c(c), value if isinstance(value, Column) else F.lit(value))


def date_or(c: Column | str, fallback: date | Column) -> Column:
    """A date, or the fallback date when it is NULL."""
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.to_date(_c(c)), fb)


def as_of_date(as_of: date | None) -> Column:
    """``current_date()`` unless a fixed date is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def ratio_pct(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator * 100`` when the denominator is positive,
    else 0.0 (F3, A10). Computed in double on both inputs so decimal and
    double money give the same number."""
    n, d = _c(numerator), _c(denominator)
    return F.when(d > 0, (n.cast("double") / d.cast("double")) * F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def share_pct(part: Column | str, total: Column | str) -> Column:
    """``part / total * 100``; NULL instead of an error when total is 0 (A10)."""
    return F.try_divide(_c(part).cast("double"), _c(total).cast("double")) * F.lit(100.0)


def mean_of(c: Column | str) -> Column:
    """Average of the non-NULL values as a double.

    Written as sum / count so that decimal money is summed exactly first;
    for double input this is exactly what ``avg`` computes."""
    c = _c(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def segment(value: Column | str) -> Column:
    """Customer segment by lifetime value (F4, C10). A NULL value matches no
    threshold and lands in the default segment."""
    v = _c(value)
    expr = None
    for label, threshold in SEGMENTS:
        expr = (F.when if expr is None else expr.when)(v >= threshold, F.lit(label))
    return expr.otherwise(F.lit(SEGMENT_DEFAULT))


def money_out(c: Column | str) -> Column:
    """Final money column as double (no-op for double input)."""
    return _c(c).cast("double")
