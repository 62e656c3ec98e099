"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.config import shared_root

#: Entries a worker's cache may hold before it is emptied; with keys of at
#: most CACHED_CHARS characters this bounds its memory.
CACHE_SIZE = 500_000
CACHED_CHARS = 64


#: Words whose hash a worker keeps; hashing one anew costs little more than a look-up.
KEPT_HASHES = 100_000
#: Rows that Spark hands to a worker at once where rows are whole texts. The
#: default of 10,000 long texts would be held several times over, in the JVM,
#: on the way and in the worker.
TEXT_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, for a query that hands whole rows to Python workers in
    batches of TEXT_ROWS (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, so a
    lost executor costs a re-read and never another plan or another sample."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/retailflow/llm-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a bit map of hashes: 16 for each, between these bounds (128 KB and 128 MB), which are broadcast.
LEAST_MAP_BITS, MOST_MAP_BITS = 20, 30


def may_be_in(
    df: DataFrame, hashed: str, wanted: DataFrame, n: int, bits: int = 64, flag: str | None = None
) -> DataFrame:
    """The rows of ``df`` whose 64-bit hash in column ``hashed`` may be one of
    ``wanted`` (one column of n hashes, of which the leading ``bits`` count):
    those whose leading bits are set in a broadcast bit map. The map's size
    is bounded, and beyond it more rows pass for which an exact join decides.
    With ``flag`` all rows, and whether they may as a column of that name."""
    map_bits = min(bits, max(LEAST_MAP_BITS, min(MOST_MAP_BITS, (16 * max(1, n) - 1).bit_length())))
    place = F.shiftrightunsigned(wanted.columns[0], 64 - map_bits)
    maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_map")
    )
    place = F.shiftrightunsigned(hashed, 64 - map_bits)
    position = F.bitmap_bit_position(place)
    byte = F.substring("_map", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    hit = F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(position, F.lit(8)).cast("int")) == 1
    found = df.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "_bucket", "left" if flag else "inner")
    found = found.withColumn(flag, F.coalesce(hit, F.lit(False))) if flag else found.where(hit)
    return found.drop("_bucket", "_map")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


class WordHashes(dict):
    """64-bit hash of a word's bytes; the most recent words are kept."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= KEPT_HASHES:
                self.clear()
            self[word] = value
        return value


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges`` (columns ``a``, ``b``, long ids):
    one row ``(id, component)`` per id that has an edge, where component is
    the smallest id reachable.

    Each round every vertex points at its smallest neighbour (or itself) and
    the graph is contracted along these pointers, so the number of vertices
    falls by a factor each round, on long chains too. The smallest id of a
    component always points at itself and so survives to name it. All steps
    are joins and min aggregates with a map-side part: a hub that a third
    of all edges share is pre-aggregated, and no neighbour list is gathered.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{label}-edges",
    )
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = ids.select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(
            both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("to")), f"{label}-least"
        )
        labels = written(
            labels.join(least.withColumnRenamed("v", "component"), "component", "left").select(
                "id", F.coalesce("to", "component").alias("component")
            ),
            f"{label}-labels",
        )
        to_a, to_b = (least.select(F.col("v").alias(c), F.col("to").alias(f"p{c}")) for c in "ab")
        edges = written(
            edges.join(to_a, "a")
            .join(to_b, "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            f"{label}-edges",
        )
    return labels
