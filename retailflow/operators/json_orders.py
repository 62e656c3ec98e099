"""The JSON orders pipeline (D16-D18): bronze stream, silver stream, daily
count. Same steps as the SQL definition (streaming table -> streaming table
-> materialised view), written as DataFrame functions; the gold step is
also given as plain Spark SQL over a DataFrame parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.operators.expectations import Expectation, apply_expectations
from retailflow.sources.files import file_name, with_audit


def json_orders_bronze(
    raw: DataFrame, audit: bool = True, expectations: tuple[Expectation, ...] = (), observation=None
) -> DataFrame:
    """``SELECT *, current_timestamp() AS processing_time,
    _metadata.file_name AS source_file``."""
    df = with_audit(raw, file_name()) if audit else raw
    return apply_expectations(df, expectations, observation)


def utc_timestamp(name: str) -> Column:
    """The moment that a text names, as wall-clock time in UTC whatever
    the session time zone. Up to 11 digits are seconds since 1970 and 12 or
    13 digits milliseconds, a text with an offset (or Z) is moved to UTC, one
    without is UTC already; unreadable text, longer numbers included, becomes
    NULL."""
    text = F.col(name)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = text.try_cast("long")
    moment = (
        F.when(text.rlike(r"^[0-9]{1,11}$"), F.timestamp_seconds(number))
        .when(text.rlike(r"^[0-9]{12,13}$"), F.timestamp_millis(number))
        .when(~text.rlike(r"^[0-9]+$"), text.try_cast("timestamp"))
    )
    zoned = text.rlike(r"^[0-9]+$|:[0-9.]+ *(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)).otherwise(
        text.try_cast("timestamp_ntz")
    )


def json_orders_silver(
    bronze: DataFrame, expectations: tuple[Expectation, ...] = (), observation=None
) -> DataFrame:
    """Four columns, the timestamp text converted."""
    df = bronze.select(
        "order_id",
        utc_timestamp("order_timestamp").alias("order_timestamp"),
        "customer_id",
        "notifications",
    )
    return apply_expectations(df, expectations, observation)


def orders_by_date(silver: DataFrame) -> DataFrame:
    """Orders per calendar day (``count(*)``)."""
    return silver.groupBy(F.to_date("order_timestamp").alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_daily_orders")
    )


def orders_by_date_sql(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """D18 as SQL text over a DataFrame parameter."""
    return spark.sql(
        """
        SELECT date(order_timestamp) AS order_date,
               count(*) AS total_daily_orders
        FROM {silver}
        GROUP BY date(order_timestamp)
        """,
        silver=silver,
    )
