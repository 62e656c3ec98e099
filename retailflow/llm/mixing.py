"""Mixing sources to target weights by Poisson replication.

A source with n documents and target weight w is to make up w of ``total``
documents, so each of its documents is repeated w x total / n times on
average. Each document draws its own count: a uniform number from a seeded
hash of its id inverts the Poisson distribution of that mean. Copies are
exploded and shuffled globally by another hash. Draws depend only on id and
seed, so a lost task repeats them exactly. A row whose id is missing or
repeated draws and is placed by the number of its row as well, so such rows
neither come and go together nor meet in one task.

A mean above CHUNK is drawn as a sum of equal parts (sums of Poisson numbers
are Poisson), which bounds the table of the distribution whatever the mean.
All steps are column expressions; the statistics have one row per weighted
source and one for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import may_be_in, written

#: Means up to it are inverted in one go.
CHUNK = 16.0
#: Values of a distribution of mean CHUNK that the table holds; beyond them lies less than 2^-52.
VALUES = 80
#: Weighted sources at most: their statistics are broadcast.
MAX_SOURCES = 10_000


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an md5, as any SQL engine has it."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def distribution(mean: Column) -> Column:
    """The cumulative probabilities of 0 .. VALUES - 1."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("sums"))

    def step(a: Column, k: Column) -> Column:
        p = a.p * mean / k
        return F.struct(p.alias("p"), F.concat(a.sums, F.array(F.element_at(a.sums, -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(VALUES - 1)), start, step, lambda a: a.sums)


def rates(docs: DataFrame, weights: dict[str, float], source: str, total: int | None) -> DataFrame:
    """``(_key, _mean, _parts, _sums)`` per weighted source and, under a null
    key, for all other rows: the mean count, in how many parts it is drawn,
    and the distribution of a part."""
    if len(weights) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} weighted sources")
    if any(not 0 <= w <= 1 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares of the whole")
    rest = max(0.0, 1.0 - sum(weights.values()))
    alone = Window.partitionBy(F.lit(0))  # of one row per weighted source
    counted = docs.groupBy(key(source, weights).alias("_key")).agg(F.count("*").alias("_n"))
    weight = F.lit(rest)
    if weights:
        shares = F.create_map(*(F.lit(x) for item in weights.items() for x in item))
        weight = F.coalesce(F.try_element_at(shares, F.col("_key")), weight)
    everything = F.sum("_n").over(alone) if total is None else F.lit(total)
    share = F.coalesce(F.try_divide("_weight", F.sum("_weight").over(alone)), F.lit(0.0))  # of the weights that occur
    mean = everything.cast("double") * share / F.col("_n").cast("double")
    parts = F.greatest(F.ceil(F.col("_mean") / CHUNK), F.lit(1)).cast("int")
    return (
        counted.withColumn("_weight", weight)
        .select("_key", mean.alias("_mean"))
        .withColumn("_parts", parts)
        .withColumn("_sums", distribution(F.col("_mean") / F.col("_parts")))
    )


def key(source: str, weights: dict[str, float]) -> Column:
    """The source if it is weighted, else null."""
    return F.when(F.col(f"`{source}`").isin(*weights), F.col(f"`{source}`"))


def mix(
    docs: DataFrame,
    weights: dict[str, float],
    seed: int = 17,
    doc_id: str = "doc_id",
    source: str = "source",
    total: int | None = None,
) -> DataFrame:
    """``(row, copy)``: the columns of ``docs`` as the struct ``row`` and the
    number of the copy from 1, in a globally shuffled order. ``weights`` gives
    sources their shares of ``total`` documents (of as many as there are, if
    None); all other sources, and rows without one, share what is left.

    A document drawn 0 times is left out, which is how a source is thinned.
    Rows that repeat an id, and rows without one, draw each for itself, by
    their number in ``docs`` (the same on every reading of the same files).
    Texts are not looked at. The share of a weighted source without documents
    goes to the others in proportion; an empty table gives no rows.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{doc_id}`").cast("string").alias("_doc"),
        key(source, weights).alias("_source"),
        F.monotonically_increasing_id().alias("_number"),
    )
    repeated = rows.where("_doc is not null").groupBy("_doc").count().where("count > 1").select("_doc")
    repeated = written(repeated, "mix-repeated")
    own = F.concat_ws(":", "_doc", F.lit("row"), "_number")
    # Only rows whose id may be repeated are shuffled to the repeated ids; a bit map tells them where they are read.
    rows = rows.withColumn("_hash", F.xxhash64("_doc"))
    rows = may_be_in(rows, "_hash", repeated.select(F.xxhash64("_doc")), repeated.count(), flag="_maybe")
    alone = rows.where("not _maybe").select("row", "_source", F.when(F.col("_doc").isNull(), own).otherwise(F.col("_doc")).alias("_id"))
    rows = rows.where("_maybe").join(repeated.withColumn("_again", F.lit(True)), "_doc", "left")
    rows = rows.select("row", "_source", F.when(F.col("_again"), own).otherwise(F.col("_doc")).alias("_id")).union(alone)
    table = rates(docs, weights, source, total)
    drawn = rows.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_key")))

    def count(part: Column) -> Column:
        u = uniform(seed, F.col("_id"), part)
        return F.size(F.filter("_sums", lambda s: s < u))

    times = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_parts")), count), F.lit(0), lambda a, n: a + n)
    copies = (
        drawn.select("row", "_id", times.alias("_times"))
        .where("_times > 0")
        .select("row", "_id", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy"))
    )
    place = F.xxhash64(F.lit(seed), "_id", "copy")
    return copies.withColumn("_place", place).repartition("_place").sortWithinPartitions("_place").select("row", "copy")
