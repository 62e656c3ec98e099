"""Global dense rank (W1) without funnelling every row into one task.

``dense_rank().over(Window.orderBy(...))`` has no partition key, so Spark
moves all rows to a single task. Here the same ranks are computed in
parallel, at every size in the same way:

1. the rows are range-partitioned in rank order and get the number of their
   range. Rows of equal value are told apart by further keys, so a value that
   a third of all rows share is spread over several ranges. The range bounds
   come from sampling, so the numbered rows are written as a table;
2. rows are ranked within their range;
3. each range hands on how many values it has, its first and its last value.
   A value carried over from the range before is not counted again; the sum
   over all earlier ranges is a range's offset (one row per range, a table
   whose size is bounded by the partition count, broadcast);
4. rank = rank in the range + offset. Nothing is joined on the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.config import STORED, run_folder


def in_ranges(df: DataFrame, value: str, ties: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """Step 1: ``df`` with the number ``_range`` of each row's range, in the
    descending order of ``value`` (NULL last). Must be written before it is
    used more than once: the range bounds are sampled."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, F.col(value).desc_nulls_last(), *ties).withColumn("_range", F.spark_partition_id())


def ranked(ranged: DataFrame, value: str, out: str) -> DataFrame:
    """Steps 2-4 on the written rows of :func:`in_ranges`."""
    none = F.col(value).isNull()
    # Values of a range, NULL being one, with what the neighbours need: its first and its last value.
    values = ranged.groupBy("_range", value).agg(F.lit(1).alias("_one"))
    ranges = values.groupBy("_range").agg(
        F.count("_one").alias("_values"),
        F.max(value).alias("_first"),
        F.when(F.bool_or(none), F.lit(None)).otherwise(F.min(value)).alias("_last"),
    )
    before = Window.orderBy("_range")  # of one row per range
    carried = (F.row_number().over(before) > 1) & F.col("_first").eqNullSafe(F.lag("_last").over(before))
    counted = ranges.select("_range", "_values", carried.cast("long").alias("_carried"))
    earlier = F.sum("_values").over(before) - F.col("_values") - F.sum("_carried").over(before)
    offsets = counted.select("_range", earlier.alias("_offset"))
    local = F.dense_rank().over(Window.partitionBy("_range").orderBy(F.col(value).desc_nulls_last()))
    rows = ranged.withColumn(out, local).join(F.broadcast(offsets), "_range")
    return rows.withColumn(out, (F.col(out) + F.col("_offset")).cast("int")).drop("_range", "_offset")


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.options(**STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_rank_desc(
    df: DataFrame, value: str, out: str, partitions: int | None = None, ties: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with the dense rank by ``value``, descending, NULL last. ``ties``
    are keys that tell rows of equal value apart. The numbered rows are
    written to the shared folder first, so the plan behind ``df`` runs once
    and a lost executor cannot change the ranges."""
    ranged = written(in_ranges(df, value, ties, partitions), f"{run_folder(df.sparkSession, 'rank')}/ranged")
    return ranked(ranged, value, out)
