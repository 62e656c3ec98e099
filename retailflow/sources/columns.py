"""Columns that appear later.

Files of one feed need not all have the same columns: a later delivery adds
one, or writes them in another order. A registry in the warehouse knows the
columns of each feed in the order in which they first appeared. Before a
stream starts, the registry is brought in line with the headers (CSV) or
footers (parquet) of the files that lie there; the stream then reads every
file by the registry's columns, and a file without one of them gives NULL.
So rows of old and new files stand in one table, in batch as in the stream.

CSV values are taken by the names in the header of their own file. Files
are told apart by their header line, of which there are few, whatever the
number of files.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from retailflow.sources.files import text_lines

#: Different header lines that the files of a feed may have.
MOST_HEADERS = 1000


def joined(known: StructType, found: StructType) -> StructType:
    """The columns of ``known``, then those that only ``found`` has. Names
    are compared as Spark does, without case; the types of ``known`` stay."""
    names = {f.name.lower() for f in known}
    new = [StructField(f.name, f.dataType, True) for f in found if f.name.lower() not in names]
    return StructType([*known.fields, *new])


def parquet_columns(spark: SparkSession, path: str) -> StructType:
    """All columns that the footers of the files at ``path`` name, and their
    partition folders; none if there are no files yet. Files that disagree on
    a type fail the call."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return StructType([])


def csv_headers(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """``(file, header)``: the first line of each CSV file at ``path``, written
    below ``folder``. A task has one file and stops after its first line."""
    own = spark.newSession()
    whole = str(1 << 50)  # no file is split, and no two files go to one task
    own.conf.set("spark.sql.files.maxPartitionBytes", whole)
    own.conf.set("spark.sql.files.openCostInBytes", whole)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.slice(0, 1)
            return

    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"))
    target = f"{folder}/headers-{uuid.uuid4().hex[:12]}"
    lines.mapInArrow(first, "file string, header string").write.parquet(target)
    return spark.read.schema("file string, header string").parquet(target)


def header_lines(headers: DataFrame) -> list[str]:
    """The different header lines, MOST_HEADERS at most."""
    found = [r.header for r in headers.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(found) > MOST_HEADERS:
        raise ValueError(f"the files have more than {MOST_HEADERS} different headers")
    return sorted(found)


def header_names(line: str) -> list[str]:
    names = next(csv.reader([line.removeprefix("﻿")]), [])
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"a column name is repeated in the header {line!r}")
    return names


def csv_columns(headers: DataFrame) -> StructType:
    """All columns that the headers name, as text."""
    columns = StructType([])
    for line in header_lines(headers):
        columns = joined(columns, StructType([StructField(n, StringType(), True) for n in header_names(line)]))
    return columns


def read_csv_by_header(
    spark: SparkSession,
    path: str,
    columns: StructType,
    headers: DataFrame,
    stream: bool = True,
    max_files: int | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV files with a header line, each read by its own header: ``columns``
    in their order, NULL where a file has no such column or a value does not
    fit its type. ``headers`` are those of :func:`csv_headers`; a file that
    came after they were taken fails the read, so that no row is misread or
    left out (the next run has its header). Lines equal to their file's header
    and empty lines are no rows. ``corrupt_column`` gets the line of a row
    with too few or too many values."""
    corrupt = corrupt_column or "_corrupt"

    def parsed(line: str) -> Column:
        own = {n.lower(): n for n in header_names(line)}
        fields = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in (*own.values(), corrupt))
        values = F.from_csv("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})

        def row(v: Column) -> Column:
            each = [
                (v.getField(own[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in columns
            ]
            return F.struct(*each, *([v.getField(corrupt).alias(corrupt)] if corrupt_column else []))

        return F.get(F.transform(F.array(values), row), F.lit(0))  # parsed once, then taken apart

    by_file = headers.groupBy(F.col("file").alias("_file")).agg(F.first("header").alias("_header"))
    lines = text_lines(spark, path, stream, max_files)
    rows = lines.join(by_file, F.col("_metadata.file_path") == F.col("_file"), "left").where(
        "_header IS NULL OR value <> _header"
    )
    late = F.raise_error(F.concat(F.lit("no header was taken of "), F.col("_metadata.file_path")))
    shape = StructType([*columns.fields, *([StructField(corrupt, StringType(), True)] if corrupt_column else [])])
    row = late.cast(shape)
    for line in header_lines(headers):
        row = F.when(F.col("_header") == line, parsed(line)).otherwise(row)
    return rows.where(F.trim("value") != "").select(row.alias("_row")).select("_row.*")
