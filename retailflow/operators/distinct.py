"""Exact distinct counts by mergeable bitmaps.

Several ``count_distinct`` in one aggregate make Spark expand every input
row, once for each distinct column and once for all the rest, and shuffle
the expanded rows on (group, value). Here a column of integers is counted
through bitmaps instead: the value is split into a bucket of 32,768 values
and a position in it, each (group, bucket) becomes a bitmap of 4 KB in the
task that reads the rows, bitmaps of equal (group, bucket) are merged by OR,
and a group's count is the sum of its buckets' bits. Input rows are neither
expanded nor shuffled. NULL values are not counted, NULL keys are a group.

Worth it where groups are few and ids are dense in each, which :func:`dense`
tells for the whole table; many groups over a wide range of ids (days and a
million customers) have a bitmap for nearly every row and go by
:func:`value_counts`; groups of a few rows each (customers, products) by
:func:`ranged_counts`. Over an input derived on the fly, which each count would
derive again, ``count_distinct`` is better.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Different values a bucket from which bitmaps are smaller than the values themselves (4 KB against 8 bytes each).
DENSE = 512


def dense(df: DataFrame, *columns: str) -> bool:
    """Whether each of the integer ``columns`` has at least DENSE different
    values to a bucket on average (both counted approximately, in one pass)."""
    counts = df.agg(
        *(F.approx_count_distinct(c).alias(f"v_{c}") for c in columns),
        *(F.approx_count_distinct(F.bitmap_bucket_number(c)).alias(f"b_{c}") for c in columns),
    ).first()
    return all(counts[f"v_{c}"] >= DENSE * counts[f"b_{c}"] > 0 for c in columns)


def bitmap_counts(df: DataFrame, keys: tuple[str, ...], value: str, out: str) -> DataFrame:
    """``keys`` and the number of different values of the integer column
    ``value`` in each group that has any."""
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.bitmap_bucket_number(value).alias("_bucket"), F.bitmap_bit_position(value).alias("_position")
    )
    maps = rows.groupBy(*keys, "_bucket").agg(F.bitmap_construct_agg("_position").alias("_map"))
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("_map")).alias(out))


def value_counts(df: DataFrame, keys: tuple[str, ...], value: str, out: str) -> DataFrame:
    """The same for a column of any type, by its different (group, value)
    rows: they hold nothing else and are no more than the rows of ``df``,
    however many groups there are and however far the values spread."""
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(value).alias(out))


def ranged_counts(df: DataFrame, keys: tuple[str, ...], value: str, out: str) -> DataFrame:
    """The same for groups that are many and small (customers, products): the
    rows are shuffled once, by ranges of the first key and the value. A group
    lies in one range, or in the few over which its many values are spread, so
    what is shuffled again for the count is about one row a group."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, value).repartitionByRange(keys[0], value)
    return rows.distinct().groupBy(*keys).agg(F.count(value).alias(out))


def agg_with_distinct(
    df: DataFrame, keys: tuple[str, ...], aggregates: list[Column], distinct: dict[str, str], counts_of=bitmap_counts, **other_counts
) -> DataFrame:
    """``df.groupBy(keys).agg(*aggregates, count_distinct(...))`` with the
    distinct counts (``{out: column}``) by ``counts_of``: bitmaps,
    :func:`value_counts` or :func:`ranged_counts`; ``other_counts`` names
    counts that go another way. Groups are joined by their keys, NULL equal
    to NULL; there is one row per group."""
    out = df.groupBy(*keys).agg(*aggregates)

    def joined(left: DataFrame, item: tuple[str, str]) -> DataFrame:
        name, value = item
        counts = other_counts.get(name, counts_of)(df, keys, value, name).withColumnsRenamed({k: f"_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, (left[k].eqNullSafe(counts[f"_{k}"]) for k in keys))
        return left.join(counts, same, "left").drop(*(f"_{k}" for k in keys))

    out = reduce(joined, distinct.items(), out)
    return out.withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in distinct})
