"""Near-duplicate documents by b-bit MinHash.

A document is the set of its different 5-word shingles. 256 linear
permutations give 256 minima; 36 bands of 7 minima each make the candidate
keys, and the low 4 bits of every minimum are packed into a signature of 16
longs. Documents that share a band are candidates; the similarity estimated
from the signatures (equal 4-bit groups, corrected for the 1/16 that agree
by chance) must come within five standard deviations of the threshold; then
the full sets decide.

No group is expanded into pairs. Documents of equal sets are one class.
Round 1 compares each member of a band's bucket with the bucket's smallest
member only. Round 2 takes the buckets whose members are then still in
different components, and compares all members of different components
there. So every pair of a bucket is either compared or already known to be
linked through others: the components are those of all candidate pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import WordHashes, components, may_be_in, written
from retailflow.llm.substrings import rolling

WORDS = 5
THRESHOLD_PERCENT = 85
PERMUTATIONS = 256
BANDS, ROWS = 36, 7
BITS = 4
#: Standard deviations that an estimate may fall short of the threshold.
MARGIN = 5.0

_SEEDS = np.random.default_rng(20240607)
_A = (_SEEDS.integers(0, 1 << 31, PERMUTATIONS, np.uint64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _SEEDS.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32)
_BAND = _SEEDS.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _SEEDS.integers(0, 1 << 63, BANDS, np.uint64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

_HASHES = WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles: of WORDS words with
    A-Z lower-cased, or of the whole sequence if it is shorter."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, and \\x20 and \\x09-\\x0D only
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return np.unique(rolling(hashes, min(WORDS, len(words)))) if words else hashes


def minima(hashes: np.ndarray) -> np.ndarray:
    x = ((hashes ^ (hashes >> np.uint64(33))) * _MIX >> np.uint64(32)).astype(np.uint32)
    least = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (_A[:, None] * x[i : i + 1024] + _B[:, None]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = (least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1) + _SALT
    return ((keys ^ (keys >> np.uint64(32))) * _MIX).view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of every minimum, two to a byte, as longs."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (low[::2] << np.uint8(BITS) | low[1::2]).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of equal 4-bit groups,
    corrected for those that agree by chance."""

    def differing(i: int) -> Column:
        d = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    unequal = reduce(add, map(differing, range(PERMUTATIONS * BITS // 64)))  # spelt out, so it is compiled
    chance = 1 / (1 << BITS)
    return ((PERMUTATIONS - unequal) / F.lit(float(PERMUTATIONS)) - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    chance = 1 / (1 << BITS)
    equal = percent / 100 * (1 - chance) + chance
    return percent / 100 - MARGIN * (equal * (1 - equal) / PERMUTATIONS) ** 0.5 / (1 - chance)


def sketches(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, text_hash) -> set size, digest of the set, band
    keys and signature. An empty set, or a row without an id, has a digest of
    its own and no bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").cast(pa.int64()), batch.column("text_hash")
            sizes, digests, bands, signatures = [], [], [], []
            for doc, value, text_hash in zip(ids.to_pylist(), batch.column("text"), texts.to_pylist()):
                hashes = shingles(value.as_py())
                sizes.append(len(hashes))
                if len(hashes) and doc is not None:
                    least = minima(hashes)
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    bands.append(band_keys(least))
                    signatures.append(packed(least))
                else:
                    digests.append(f"alone {doc} {text_hash}".encode())
                    bands.append(None)
                    signatures.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids, texts, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(bands, longs), pa.array(signatures, longs),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "bands", "signature"],
            )

    return docs.mapInArrow(
        sketch,
        "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, signature array<long>",
    )


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``texts`` (class, text) -> the set of each class."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [shingles(t.as_py()).view(np.int64) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("class"), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"]
                )

    return texts.mapInArrow(sets, "id long, shingles array<long>")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """Per input row: ``n_shingles``, ``component_id`` (the smallest id that
    links reach, its own included), ``kept`` (it is that smallest) and
    ``text_hash`` (xxhash64 of the text, which tells rows of one id apart).
    Two documents are linked if 100 x shared shingles >= ``percent`` x all
    their different shingles, counted on the full sets.

    A null or empty text, or one of white space only, has an empty set, is
    linked with nothing and kept. A row without an id takes no part: its
    component is null and it is kept. Rows that repeat an id are one
    document: each is judged by its own text, and links of either hold for
    the id. Rows that repeat an id and a text are one set, however many. Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketched = written(sketches(docs.withColumn("text_hash", F.xxhash64("text"))), "sketches")
    # One row per set, copies combined in each task. Written, so the joins below shuffle both sides anew and a
    # digest that very many copies share can be split.
    sketch = (F.first(c).alias(c) for c in ("bands", "signature"))
    classes = written(
        sketched.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("_first"), *sketch)
        .select(
            F.monotonically_increasing_id().alias("class"), "digest", F.col("_first.doc_id").alias("rep"),
            F.col("_first.text_hash").alias("rep_hash"), "bands", "signature",
        ),
        "classes",
    )
    members = sketched.select("doc_id", "text_hash", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest")
    reps = classes.where("bands is not null").select("class", "rep", "rep_hash", "bands", "signature")
    banded = reps.select(F.explode("bands").alias("band"), "class", "rep")
    shared = banded.groupBy("band").agg(F.min(F.struct("rep", "class")).alias("_least"), F.max(F.struct("rep", "class")).alias("_most"))
    shared = shared.where("_least < _most").select("band", F.col("_least.class").alias("first"))
    banded = written(banded.join(shared, "band"), "banded")
    signatures = reps.select(F.col("class").alias("id"), "signature")
    wanted = reps.join(banded.select("class").distinct(), "class", "left_semi")
    wanted = written(wanted.select("class", F.col("rep").alias("doc_id"), F.col("rep_hash").alias("text_hash")), "wanted")
    # Only texts that a set may be wanted of are shuffled: a bit map picks them where they are read, whatever the size.
    # Rows that repeat an id and a text are combined in each task.
    key = F.xxhash64("doc_id", "text_hash")
    hashed = docs.withColumn("text_hash", F.xxhash64("text")).withColumn("_key", key)
    texts = may_be_in(hashed, "_key", wanted.select(key), wanted.count())
    texts = texts.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    sets = written(shingle_sets(texts.join(wanted.hint("merge"), ["doc_id", "text_hash"]).select("class", "text")), "sets")

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(*(F.col(c).alias(name if c == "id" else f"{name}_{c}") for c in table.columns))

    close = estimate(F.col("a_signature"), F.col("b_signature")) >= least_estimate(percent)
    shared_size = F.size(F.array_intersect("a_shingles", "b_shingles")).cast("long")
    all_size = F.size("a_shingles") + F.size("b_shingles") - shared_size
    confirmed = 100 * shared_size >= percent * all_size

    star = banded.where("class <> first").select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    star = star.join(side(signatures, "a"), "a").join(side(signatures, "b"), "b").where(close).select("a", "b")
    star = star.join(side(sets, "a"), "a").join(side(sets, "b"), "b").where(confirmed)
    links = written(star.select("a", "b"), "links")

    def by_id(links: DataFrame) -> DataFrame:
        a, b = (classes.select(F.col("class").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "ab")
        return links.join(a, "a").join(b, "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    found = components(by_id(links), "near")

    labelled = banded.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "band", "class", F.coalesce("component", "rep").alias("part")
    )
    split = labelled.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("band")
    rest = written(
        labelled.join(split, "band")
        .join(reps.select("class", "bands", "signature"), "class")
        .withColumnRenamed("class", "id")
        .join(sets, "id"),
        "rest",
    )
    a = side(rest, "a").withColumnRenamed("a_band", "band")
    b = side(rest, "b").withColumnRenamed("b_band", "band")
    # A pair is judged in the first band that both have, and only if it is linked does it leave the join.
    first = F.get(F.array_intersect("a_bands", "b_bands"), F.lit(0)) == a.band
    across = a.join(b, (a.band == b.band) & (F.col("a_part") < F.col("b_part")) & close & first & confirmed)
    links = links.union(across.select("a", "b"))
    found = components(by_id(links), "near-all").withColumnRenamed("id", "rep")
    return members.join(found, "rep", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "rep").alias("component_id"),
        F.coalesce(F.coalesce("component", "rep") == F.col("doc_id"), F.lit(True)).alias("kept"),
        "text_hash",
    )
