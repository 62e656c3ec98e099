"""File sources (S1-S12): one reader per raw feed, batch or incremental.

``stream=True`` gives a Structured Streaming file source: each run picks up
only files it has not seen (exactly-once with a checkpoint). The same
reader with ``stream=False`` reads a snapshot. Schemas are always explicit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

from retailflow import schemas
from retailflow.functions import whole_number

# Bytes of input that a micro-batch takes at most (at least one file).
MAX_BYTES_PER_TRIGGER = 256 * 1024**3


def _reader(spark: SparkSession, stream: bool, schema: StructType, max_files: int | None):
    """``max_files`` bounds a micro-batch by files instead of bytes (Spark
    takes one of the two)."""
    r = spark.readStream if stream else spark.read
    r = r.schema(schema)
    if stream and max_files:
        return r.option("maxFilesPerTrigger", str(max_files))
    return r.option("maxBytesPerTrigger", str(MAX_BYTES_PER_TRIGGER)) if stream else r


def text_lines(spark: SparkSession, path: str, stream: bool, max_files: int | None = None) -> DataFrame:
    """The lines of text files as ``value``."""
    return _reader(spark, stream, StructType([StructField("value", StringType(), True)]), max_files).text(path)


def header_schema(spark: SparkSession, path: str, declared: StructType) -> StructType:
    """The columns of the CSV files at ``path`` by their header line: declared
    types for declared names in whatever order, text for all others."""
    types = {f.name: f.dataType for f in declared}
    names = spark.read.option("header", "true").csv(path).columns
    return StructType([StructField(n, types.get(n, StringType()), True) for n in names])


def read_customers(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    max_files: int | None = None,
    schema: StructType | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Directory of customer CSV files with a header line (S1). A file whose
    header does not name the expected columns in their order fails the read;
    pass ``schema=header_schema(...)`` to take other orders and further
    columns as they are. ``corrupt_column`` names a column that gets the
    whole line of a row with too few or too many values."""
    schema = schema or schemas.customer_schema()
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
    reader = _reader(spark, stream, schema, max_files).option("header", "true").option("enforceSchema", "false")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.option("mode", "PERMISSIVE").csv(path)


def read_orders(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    money: DataType = DoubleType(),
    max_files: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Directory of order parquet files, possibly month-partitioned.
    ``schema`` has further columns (``sources.columns``)."""
    return _reader(spark, stream, schema or schemas.order_schema(money), max_files).parquet(path)


def read_products(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    money: DataType = DoubleType(),
    max_files: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Product parquet partitioned by ``category=`` directories (S3); the
    default partition reads back as NULL."""
    return _reader(spark, stream, schema or schemas.product_schema(money), max_files).parquet(path)


def read_geographies(spark: SparkSession, path: str, corrupt_column: str | None = None) -> DataFrame:
    """The geography CSV file, batch (S4), by its header line: declared
    columns in their order whatever the file's, further columns after them as
    text. Ids are text, so one that is no number is seen (bronze converts).
    A file without a declared column fails the read."""
    declared = schemas.geography_schema()
    found = header_schema(spark, path, StructType([StructField(f.name, StringType(), True) for f in declared]))
    if missing := [f.name for f in declared if f.name not in found.names]:
        raise ValueError(f"{path} has no column {', '.join(missing)} in its header")
    columns = [*declared.names, *(n for n in found.names if n not in declared.names)]
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if corrupt_column:
        found = StructType([*found.fields, StructField(corrupt_column, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        columns.append(corrupt_column)
    return reader.schema(found).csv(path).select(*columns)


def read_json_orders(
    spark: SparkSession, source_root: str, stream: bool = True, max_files: int | None = None
) -> DataFrame:
    """JSON order files below ``{source}/orders``."""
    return _reader(spark, stream, schemas.json_order_schema(), max_files).json(
        f"{source_root.rstrip('/')}/orders"
    )


def read_json_records(
    spark: SparkSession, source_root: str, stream: bool = True, max_files: int | None = None
) -> DataFrame:
    """The same files without loss (S5, P1): the declared columns, then
    ``record``, the whole record as a VARIANT with every field the file has,
    and ``broken_line``, the line itself where it is no JSON.

    ``order_id`` and ``customer_id`` are numbers where the file has whole
    numbers or texts of them, else NULL; ``order_id_text`` and
    ``customer_id_text`` hold them as they came. A line that holds an array
    gives a row for each element, an empty line none."""
    lines = text_lines(spark, f"{source_root.rstrip('/')}/orders", stream, max_files)
    parsed = lines.where(F.trim("value") != "").withColumn("_parsed", F.try_parse_json("value"))
    several = F.coalesce(F.try_variant_get("_parsed", "$", "array<variant>"), F.array("_parsed"))
    records = parsed.select("value", F.explode(several).alias("record"))

    def field(name: str) -> Column:
        return F.try_variant_get("record", f"$.{name}", "string")

    ids = ("order_id", "customer_id")
    declared = schemas.json_order_schema()
    return records.select(
        *((whole_number(field(n)) if n in ids else field(n)).alias(n) for n in declared.names),
        *(field(n).alias(f"{n}_text") for n in ids),
        "record",
        F.when(F.col("record").isNull(), F.col("value")).alias("broken_line"),
    )


def read_table(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    max_files: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """An upstream dataset written by this pipeline (S11, S12). The stream
    form follows the sink's commit log, so it sees each file exactly once;
    pass the upstream's ``schema`` (known from the DataFrame that wrote it)
    so that an upstream without files yet can be followed too."""
    if not stream:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    if schema is None:
        schema = spark.read.parquet(path).schema
    return _reader(spark, True, schema, max_files).parquet(path)


def file_path() -> Column:
    """Full path of the file a row came from."""
    return F.col("_metadata.file_path")


def file_name() -> Column:
    """Name of the file a row came from."""
    return F.col("_metadata.file_name")


def with_audit(df: DataFrame, source: Column | None = None) -> DataFrame:
    """``select("*", processing_time, source_file)``.

    ``current_timestamp()`` is fixed per query / micro-batch. ``source``
    defaults to the full file path; pass ``F.lit(name)`` for a constant or
    ``file_name()`` for the bare name.
    """
    src = file_path() if source is None else source
    return df.select(
        "*",
        F.current_timestamp().alias("processing_time"),
        src.alias("source_file"),
    )
