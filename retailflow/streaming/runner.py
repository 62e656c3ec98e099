"""Incremental runs of the bronze and silver tables (T1-T5, K1) and full
refreshes of batch tables (K2).

Each streaming table is one Structured Streaming query with its own
checkpoint and ``trigger(availableNow)``: it processes every file that
arrived since the last run and stops. A micro-batch is written into a
folder named by its number, replacing what an earlier attempt at the same
batch left there, so a replayed batch changes nothing; each task writes what
it has read or joined, without another shuffle. A scan packs small files and
splits large ones by bytes, and adaptive execution does so with shuffled rows,
so the number of files follows from the data. Rerunning with no new files adds nothing; a new
file adds only its rows. A downstream stream follows the batch folders; it
starts after its upstream has finished, so it never sees half a batch.

A batch table is written as a new version, in a folder of its own, and
becomes the table when a small pointer file naming it is added, last of
all. Readers resolve the pointer to a folder that no refresh touches again:
one that started earlier finishes on the old version, and a crash before
the pointer leaves the old version in place. ``remove_old_versions`` clears
versions that have been out of use for some time.

Tables run in dependency order and each query is awaited before its
dependants start, so a static side (the product and customer dimensions
joined to the order stream) is a complete snapshot when the fact stream
reads it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, DoubleType, StructType

from retailflow import schemas
from retailflow.config import STORED
from retailflow.operators import bronze, json_orders, silver
from retailflow.operators.expectations import Expectation, failing, kept, metrics, violated
from retailflow.sources import files
from retailflow.sources.columns import csv_columns, csv_headers, joined, parquet_columns, read_csv_by_header
from retailflow.sources.landing import Landing

#: Seconds that an old version of a batch table stays for its readers.
RETENTION_SECONDS = 7 * 24 * 3600

KEPT = "_kept=true"
#: What the pointer of a streaming table names.
ALL_BATCHES = f"{KEPT}/_batch=*"


@dataclass(frozen=True)
class Warehouse:
    """Where tables and their checkpoints live (a shared folder)."""

    root: str

    def folder(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def pointers(self, name: str) -> str:
        return f"{self.root}/pointers/{name}"

    def table(self, name: str) -> str:
        """Where Spark reads table ``name``: the current version of a batch
        table, the batches of a streaming table."""
        return f"{self.folder(name)}/{current_version(SparkSession.active(), self, name) or ALL_BATCHES}"

    def kept(self, name: str) -> str:
        """All batches of a streaming table, one folder each."""
        return f"{self.folder(name)}/{KEPT}"

    def quarantine(self, name: str) -> str:
        """The rows that rules kept out of a streaming table."""
        return f"{self.folder(name)}/_kept=false/_batch=*"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


RESULTS = "expectation_results"
RESULTS_SCHEMA = (
    "dataset string, batch_id long, rule string, condition string, action string, rows_seen long, violations long"
)


def _by_bytes(df: DataFrame) -> DataFrame:
    """A batch that ends in a ``repartition`` of its own is dealt by bytes in
    its place (Spark makes one shuffle of the two); others stay as they are."""
    last = df._jdf.queryExecution().analyzed().getClass().getSimpleName()
    return df.hint("rebalance") if last in ("Repartition", "RepartitionByExpression") else df


def write_batch(df: DataFrame, wh: Warehouse, name: str, batch_id: int, rules: tuple[Expectation, ...] = ()) -> None:
    """Writes a micro-batch as its own folder, whatever stood there before.
    Rows that a ``drop`` rule rejects go to quarantine in the same write; the
    counts of violations, taken in the same pass, are written as the batch's
    rows of the results table, last."""
    df = _by_bytes(df)
    if not rules:
        df.write.mode("overwrite").options(**STORED).parquet(f"{wh.kept(name)}/_batch={batch_id}")
        return
    seen = Observation()
    flagged = failing(df.observe(seen, *metrics(rules)), rules)
    flagged = flagged.withColumns({"_kept": kept(rules), "_batch": F.lit(batch_id)})
    writer = flagged.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **STORED)
    writer.partitionBy("_kept", "_batch").parquet(wh.folder(name))
    try:
        counts = seen.get
    except Py4JJavaError:  # Spark leaves the observation out of the plan of a batch that it finds empty
        counts = df.agg(*metrics(rules)).first().asDict()
    rows = [
        (name, batch_id, r.name, r.condition, r.action, counts["rows_seen"], counts[f"violations_{r.name}"]) for r in rules
    ]
    results = df.sparkSession.createDataFrame(rows, RESULTS_SCHEMA).coalesce(1)
    results.write.mode("overwrite").parquet(f"{wh.folder(RESULTS)}/{name}/batch-{batch_id}")


def expectation_results(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Rows seen and violations per dataset, micro-batch and rule."""
    return spark.read.schema(RESULTS_SCHEMA).parquet(f"{wh.folder(RESULTS)}/*/batch-*")


def quarantined(spark: SparkSession, wh: Warehouse, name: str, rules: tuple[Expectation, ...], schema=None) -> DataFrame:
    """The rows that ``rules`` kept out of table ``name``, with the names of
    the rules they violate as ``violated_rules``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(wh.quarantine(name)).withColumn("violated_rules", violated(rules))


def run_stream_table(
    df: DataFrame, wh: Warehouse, name: str, rules: tuple[Expectation, ...] = ()
) -> StreamingQuery:
    """Append the stream into table ``name`` until all available input is
    processed; raise if the query failed. The violations of ``rules`` are
    also observed in the query's progress as ``<name>_expectations``."""
    if rules:
        df = df.observe(f"{name}_expectations", *metrics(rules))
    spark = df.sparkSession
    # An empty batch with the columns, so a table without input can be read too.
    spark.createDataFrame([], df.schema).coalesce(1).write.mode("ignore").parquet(f"{wh.kept(name)}/_batch=start")
    _pointer(spark, ALL_BATCHES, 0).write.mode("ignore").json(wh.pointers(name))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, wh, name, batch_id, rules)

    writer = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", wh.checkpoint(name))
        .queryName(name)
        .trigger(availableNow=True)
    )
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return q


def run_concurrently(*steps: Callable[[], object], at_once: int | None = None) -> list:
    """Run independent steps as concurrent Spark jobs (one driver thread
    each), all of them or ``at_once`` at a time, in their order; the scheduler
    shares the executors between them. The threads
    carry the caller's local properties (job group, description, scheduler
    pool), so cancelling the caller's job group stops them too. Returns
    their results in order; the first failure is raised."""
    if len(steps) == 1:
        return [steps[0]()]
    with ThreadPoolExecutor(max_workers=at_once or len(steps)) as pool:
        carry = inheritable_thread_target(SparkSession.active())
        futures = [pool.submit(carry(step)) for step in steps]
        return [f.result() for f in futures]


POINTER_SCHEMA = "version string, written long"


def _pointer(spark: SparkSession, version: str, written: int) -> DataFrame:
    return spark.createDataFrame([(version, written)], POINTER_SCHEMA).coalesce(1)


def versions(spark: SparkSession, wh: Warehouse, name: str) -> list[tuple[str, int]]:
    """The versions that table ``name`` has had, in order, with when each was
    written (nanoseconds)."""
    try:
        found = spark.read.schema(POINTER_SCHEMA).json(wh.pointers(name)).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(((r.version, r.written) for r in found), key=lambda r: (r[1], r[0]))


def current_version(spark: SparkSession, wh: Warehouse, name: str) -> str | None:
    """The folder, below that of the table, which its newest pointer names."""
    found = versions(spark, wh, name)
    return found[-1][0] if found else None


def refresh_table(
    df: DataFrame, wh: Warehouse, name: str, cluster_by: tuple[Column | str, ...] = ()
) -> str:
    """Full recompute of a batch table (K2); returns the folder of the new
    version. ``cluster_by`` sorts the rows into files of disjoint key ranges
    (O1, O2), so a reader that wants the order, or a part of the keys, finds
    it file by file."""
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex[:12]}"
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.options(**STORED).parquet(f"{wh.folder(name)}/{version}")
    # One file, which appears whole or not at all: from here on it is the table.
    _pointer(spark, version, time.time_ns()).write.mode("append").json(wh.pointers(name))
    return f"{wh.folder(name)}/{version}"


def remove_old_versions(spark: SparkSession, wh: Warehouse, name: str, retention: float = RETENTION_SECONDS) -> list[str]:
    """Deletes the versions of a batch table that were replaced more than
    ``retention`` seconds ago; returns their folders. Pointers stay (a few
    bytes a refresh), so the current version is never in doubt."""
    found, gone = versions(spark, wh, name), []
    now = time.time_ns()
    for (version, _), (_, replaced) in zip(found, found[1:]):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{wh.folder(name)}/{version}")
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if replaced <= now - retention * 1e9 and fs.exists(path) and fs.delete(path, True):
            gone.append(f"{wh.folder(name)}/{version}")
    return gone


def known_columns(spark: SparkSession, wh: Warehouse, feed: str, declared: StructType, found: StructType) -> StructType:
    """The columns of a feed: the declared ones, those known from earlier
    runs, and those that files have by now, which the registry then keeps."""
    name = f"columns/{feed}"
    known = declared
    if version := current_version(spark, wh, name):
        kept_text = spark.read.schema("columns string").parquet(f"{wh.folder(name)}/{version}").first().columns
        known = StructType.fromJson(json.loads(kept_text))
    columns = joined(joined(declared, known), found)
    if columns != known or version is None:
        refresh_table(spark.createDataFrame([(columns.json(),)], "columns string").coalesce(1), wh, name)
    return columns


def run_product_bronze(
    spark: SparkSession, path: str, wh: Warehouse, money: DataType = DoubleType(), max_files: int | None = None
) -> tuple[StreamingQuery, StructType]:
    """D5 as a stream, by all columns that the files have; the run and the
    columns of the table."""
    columns = known_columns(spark, wh, "products", schemas.product_schema(money), parquet_columns(spark, path))
    df = bronze.product_bronze(files.read_products(spark, path, True, money, max_files, columns))
    return run_stream_table(df, wh, "product_bronze_v1"), df.schema


def run_customer_bronze(
    spark: SparkSession, path: str, wh: Warehouse, max_files: int | None = None
) -> tuple[StreamingQuery, StructType]:
    """D1 as a stream, each file by its own header."""
    headers = csv_headers(spark, path, wh.folder("columns"))
    columns = known_columns(spark, wh, "customers", schemas.customer_schema(), csv_columns(headers))
    df = bronze.customer_bronze(read_csv_by_header(spark, path, columns, headers, True, max_files))
    return run_stream_table(df, wh, "customer_bronze_v1"), df.schema


def run_orders_bronze(
    spark: SparkSession, path: str, wh: Warehouse, money: DataType = DoubleType(), max_files: int | None = None
) -> tuple[StreamingQuery, StructType]:
    """D3 as a stream, by all columns that the files have."""
    columns = known_columns(spark, wh, "orders", schemas.order_schema(money), parquet_columns(spark, path))
    df = bronze.orders_bronze(files.read_orders(spark, path, True, money, max_files, columns))
    return run_stream_table(df, wh, "orders_bronze_v1"), df.schema


def read_all_columns(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame:
    """Table ``name`` with the columns of all its batches; rows of a batch
    without one have NULL there."""
    return spark.read.option("mergeSchema", "true").parquet(wh.table(name))


def run_retail_streams(
    spark: SparkSession,
    landing: Landing,
    wh: Warehouse,
    as_of: date | None = None,
    money: DataType = DoubleType(),
    max_files: int | None = None,
) -> dict[str, StreamingQuery]:
    """Bronze and silver of the retail pipeline. The product chain, the
    customer chain and the order bronze do not depend on each other and run
    concurrently; the order fact starts once all three are complete."""
    runs: dict[str, StreamingQuery] = {}
    columns: dict[str, StructType] = {}

    def upstream(name: str) -> DataFrame:
        return files.read_table(spark, wh.table(name), stream=True, max_files=max_files, schema=columns[name])

    def products() -> None:
        name = "product_bronze_v1"
        runs[name], columns[name] = run_product_bronze(spark, landing.products, wh, money, max_files)
        runs["product_silver_v2"] = run_stream_table(silver.product_silver(upstream(name)), wh, "product_silver_v2")

    def customers() -> None:
        # geography: batch reference data, fully refreshed, then the
        # customer stream joined to its snapshot
        geo_raw = files.read_geographies(spark, landing.geographies)
        geo_b = spark.read.parquet(refresh_table(bronze.geography_bronze(geo_raw), wh, "geography_bronze_v1"))
        geo = spark.read.parquet(refresh_table(silver.geography_silver(geo_b), wh, "geography_silver"))
        name = "customer_bronze_v1"
        runs[name], columns[name] = run_customer_bronze(spark, landing.customers, wh, max_files)
        dim = silver.dim_customer(upstream(name), geo)
        runs["dim_customer_silver_v2"] = run_stream_table(dim, wh, "dim_customer_silver_v2")

    def orders_bronze() -> None:
        name = "orders_bronze_v1"
        runs[name], columns[name] = run_orders_bronze(spark, landing.orders, wh, money, max_files)

    run_concurrently(products, customers, orders_bronze)

    # orders (stream) joined to the product and customer snapshots
    products = spark.read.parquet(wh.table("product_silver_v2"))
    customers = spark.read.parquet(wh.table("dim_customer_silver_v2"))
    fact = silver.orders_silver(upstream("orders_bronze_v1"), products, customers, as_of)
    runs["orders_silver"] = run_stream_table(fact, wh, "orders_silver")
    return runs


def run_json_streams(
    spark: SparkSession,
    source_root: str,
    wh: Warehouse,
    bronze_rules: tuple[Expectation, ...] = (),
    silver_rules: tuple[Expectation, ...] = (),
    max_files: int | None = None,
) -> dict[str, StreamingQuery]:
    """Bronze and silver of the JSON orders pipeline (D16, D17). The bronze
    table keeps every record whole; what the rules find is in the results
    and quarantine tables."""
    runs: dict[str, StreamingQuery] = {}
    b = json_orders.json_orders_bronze(files.read_json_records(spark, source_root, stream=True, max_files=max_files))
    runs["orders_bronze_demo3"] = run_stream_table(b, wh, "orders_bronze_demo3", bronze_rules)
    up = files.read_table(spark, wh.table("orders_bronze_demo3"), stream=True, max_files=max_files, schema=b.schema)
    runs["orders_silver_demo3"] = run_stream_table(
        json_orders.json_orders_silver(up), wh, "orders_silver_demo3", silver_rules
    )
    return runs
