"""Raw-file layouts of the retail feeds.

Writes the raw inputs the way they land in the raw zone: one geography CSV,
customers as several CSV files, products as parquet partitioned by
category, orders as parquet partitioned by month, JSON orders under
``{source}/orders``. Every writer is a distributed Spark write; no feed is
gathered on the driver. Only the geography reference table is written as a
single file (one row per city: a bounded, tiny table).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.config import STORED
from retailflow.functions import parse_mixed_date
from retailflow.sources import testdata

# Rows per customer CSV file in the original feed.
CUSTOMER_FILE_ROWS = 2500


@dataclass(frozen=True)
class Landing:
    root: str

    @property
    def geographies(self) -> str:
        return f"{self.root}/geographies.csv"

    @property
    def customers(self) -> str:
        return f"{self.root}/customers"

    @property
    def products(self) -> str:
        return f"{self.root}/products"

    @property
    def orders(self) -> str:
        return f"{self.root}/orders"

    @property
    def json_source(self) -> str:
        """``${source}`` of the JSON pipeline; files are under ``/orders``."""
        return f"{self.root}/json"


def _csv_writer(df: DataFrame, mode: str):
    """Header line; values written as they are (Spark's CSV writer trims
    surrounding blanks by default, which would clean the raw data)."""
    return (
        df.write.mode(mode)
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )


def write_single_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A small reference table as one CSV file with a header."""
    _csv_writer(df.coalesce(1), mode).csv(path)


def write_csv_files(df: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "append") -> None:
    """K9: CSV files, one per task, of at most ``rows_per_file`` rows each if
    given (CUSTOMER_FILE_ROWS is the original feed's)."""
    _csv_writer(df, mode).option("maxRecordsPerFile", rows_per_file or 0).csv(path)


def write_by_category(df: DataFrame, path: str, mode: str = "append") -> None:
    """K7: parquet partitioned by category; NULL goes to the default partition.

    The ``rebalance`` hint lets AQE cut the shuffle into evenly sized
    partitions: few files per directory, and a category holding a third of
    all rows is still written by several tasks."""
    df.hint("rebalance", "category").write.mode(mode).options(**STORED).partitionBy("category").parquet(path)


def with_year_month(df: DataFrame) -> DataFrame:
    """Month of the (mixed-format) order date; unreadable dates get NULL,
    which lands in the default partition."""
    return df.withColumn("year_month", F.date_format(parse_mixed_date("order_date"), "yyyy-MM"))


def write_by_month(df: DataFrame, path: str, mode: str = "append") -> None:
    """K8: orders partitioned by ``year_month`` directories, rebalanced like
    :func:`write_by_category` (a hot month is split, small months are not
    scattered over one small file per task)."""
    with_year_month(df).hint("rebalance", "year_month").write.mode(mode).options(**STORED).partitionBy("year_month").parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Lines of text (one column) as they are."""
    df.write.mode(mode).text(path)


def land_test_feeds(spark: SparkSession, sf_dir: str, root: str) -> Landing:
    """Derive every raw feed from the test tables and write it in its
    raw-zone layout below ``root``."""
    from concurrent.futures import ThreadPoolExecutor

    land = Landing(root)
    feeds = {name: testdata.raw(spark, sf_dir, name) for name in testdata.RAW_BUILDERS}
    writes = [
        lambda: write_single_csv(feeds["geographies"], land.geographies),
        lambda: write_csv_files(feeds["customers"], land.customers),
        lambda: write_by_category(feeds["products"], land.products),
        lambda: write_by_month(feeds["orders"], land.orders),
        lambda: write_json(feeds["json_orders"], f"{land.json_source}/orders"),
    ]
    # five independent writes: concurrent jobs share the executors
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        carry = inheritable_thread_target(spark)
        for f in [pool.submit(carry(w)) for w in writes]:
            f.result()
    return land
