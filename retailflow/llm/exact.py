"""Exact duplicates by counting quotient filters.

Every text is normalised and hashed. The fingerprint of a hash is as many of
its leading bits as the number of rows asks for, plus REMAINDER_BITS. Each
partition builds counting quotient filters of its fingerprints: a
fingerprint is split into quotient and remainder, remainders are stored
sorted by quotient, and a count is kept beside those met more than once.
Filters are cut into slices of equal fingerprint ranges. All parcels of a
slice merge without loss, as quotient and remainder give the fingerprint
back: the sorted remainders are merged and counts added. Fingerprints that
then count more than one go to byte verification: only rows that may have
one send their text, and texts are compared byte by byte while they are
grouped, copies being combined before the shuffle.

A fingerprint that a third of all rows share is one entry with a count in
each filter, and one text per task in the verification. What is shuffled:
the parcels (about 3 bytes a fingerprint), texts of candidate rows, and
rows of id, length and digest.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import may_be_in, written

#: Bits of a fingerprint beyond those that number the rows: of n different texts, about n / 2^16 meet another's by chance.
REMAINDER_BITS = 16
#: Rows whose fingerprints one filter of a partition holds, and about as many as a slice holds in all.
FILTER_ROWS = 1 << 20

SPACE = b" \t\n\x0b\x0c\r"
_DTYPES = (np.uint8, np.uint16, np.uint32, np.uint64)
_HEADER = struct.Struct("<BBIII")


class CountingQuotientFilter:
    """A set of fingerprints of ``bits`` bits with counts, as one slot for
    each: ``occupied`` has a bit for every quotient, ``run_ends`` a bit for
    every slot (the last of its quotient), ``remainders`` are sorted within
    their quotient, and ``repeats`` number the slots whose count, in
    ``extra``, is above one."""

    def __init__(self, bits: int, prints: np.ndarray, counts: np.ndarray):
        """``prints`` are sorted and different."""
        self.bits, self.n = bits, len(prints)
        self.q = min(bits, max(0, self.n.bit_length() - 1))
        rest = np.uint64(bits - self.q)
        quotients = (prints >> rest).astype(np.int64) if self.q else np.zeros(self.n, np.int64)
        occupied = np.zeros(1 << self.q, bool)
        occupied[quotients] = True
        self.occupied = np.packbits(occupied)
        self.run_ends = np.packbits(np.append(quotients[1:] != quotients[:-1], True)[: self.n])
        mask = np.uint64((1 << int(rest)) - 1)
        self.remainders = (prints & mask).astype(self._dtype())
        self.repeats = np.flatnonzero(counts > 1).astype(np.uint32)
        self.extra = counts[self.repeats].astype(np.int64)

    def _dtype(self) -> type:
        size = max(1, -(-(self.bits - self.q) // 8))
        return _DTYPES[(size - 1).bit_length()]

    @classmethod
    def of(cls, bits: int, prints: np.ndarray, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """Of any fingerprints, in any order."""
        if counts is None:
            return cls(bits, *np.unique(prints, return_counts=True))
        order = np.argsort(prints, kind="stable")
        prints, counts = prints[order], counts[order]
        first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])[: len(prints)])
        return cls(bits, prints[first], np.add.reduceat(counts, first) if len(first) else counts)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints in order, and their counts."""
        ends = np.unpackbits(self.run_ends, count=self.n).astype(np.int64)
        run = np.cumsum(ends) - ends
        quotients = np.flatnonzero(np.unpackbits(self.occupied, count=1 << self.q)).astype(np.uint64)
        rest = np.uint64(self.bits - self.q)
        high = quotients[run] << rest if self.q else np.zeros(self.n, np.uint64)
        counts = np.ones(self.n, np.int64)
        counts[self.repeats] = self.extra
        return high | self.remainders.astype(np.uint64), counts

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Without loss: the sorted fingerprints of all, equal ones with their counts added."""
        prints, counts = zip(*(f.items() for f in filters))
        return cls.of(filters[0].bits, np.concatenate(prints), np.concatenate(counts))

    def dump(self) -> bytes:
        head = _HEADER.pack(self.bits, self.q, self.n, len(self.repeats), len(self.occupied))
        arrays = (self.occupied, self.run_ends, self.remainders, self.repeats, self.extra)
        return head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def load(cls, blob: bytes) -> CountingQuotientFilter:
        f = cls.__new__(cls)
        f.bits, f.q, f.n, repeats, occupied = _HEADER.unpack_from(blob)
        at = _HEADER.size
        for name, dtype, n in (
            ("occupied", np.uint8, occupied), ("run_ends", np.uint8, -(-f.n // 8)), ("remainders", f._dtype(), f.n),
            ("repeats", np.uint32, repeats), ("extra", np.int64, repeats),
        ):
            setattr(f, name, np.frombuffer(blob, dtype, n, at))
            at += n * np.dtype(dtype).itemsize
        return f


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, SPACE)


def _hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _signed(hashes: list[int]) -> pa.Array:
    return pa.array(np.array(hashes, np.uint64).view(np.int64))


def described(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, code points of the text, SHA-256 and
    64-bit hash of the normalised text, and a number for the row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            plain = [normalised(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([hashlib.sha256(t).digest() for t in plain], pa.binary()),
                    _signed([_hash(t) for t in plain]),
                ],
                names=["doc_id", "n_chars", "digest", "hash"],
            )

    rows = docs.mapInArrow(describe, "doc_id long, n_chars long, digest binary, hash long")
    return rows.withColumn("row", F.monotonically_increasing_id())


def fingerprint(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits)


def repeated_fingerprints(rows: DataFrame, bits: int, slices: int, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """``print``: the fingerprints that count more than one in ``rows``
    (hash). ``slices`` is a power of two."""
    slice_bits = slices.bit_length() - 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parcels(parts: list[np.ndarray]) -> pa.RecordBatch:
            prints, counts = np.unique(np.concatenate(parts), return_counts=True)
            of = (prints >> np.uint64(bits - slice_bits)) if slice_bits else np.zeros(len(prints), np.uint64)
            found, begin = np.unique(of, return_index=True)
            low = prints & np.uint64((1 << (bits - slice_bits)) - 1)
            cuts = list(zip(begin, np.append(begin[1:], len(prints))))
            blobs = [CountingQuotientFilter(bits - slice_bits, low[i:j], counts[i:j]).dump() for i, j in cuts]
            return pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), pa.array(blobs, pa.binary())], names=["slice", "filter"]
            )

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= filter_rows:
                yield parcels(held)
                held = []
        if held:
            yield parcels(held)

    def merge(slice_: tuple, parcels: pa.Table) -> pa.Table:
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.load(b) for b in parcels["filter"].to_pylist()])
        prints, counts = whole.items()
        high = np.uint64(slice_[0].as_py() << (bits - slice_bits))
        return pa.table({"print": pa.array((prints[counts > 1] | high).view(np.int64))})

    filters = rows.select(fingerprint(bits).alias("print")).mapInArrow(build, "slice long, filter binary")
    return filters.groupBy("slice").applyInArrow(merge, "print long")


def normalised_texts(docs: DataFrame) -> DataFrame:
    """``docs`` (text) -> ``hash`` and the normalised text as bytes."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [normalised(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [_signed([_hash(t) for t in plain]), pa.array(plain, pa.binary())], names=["hash", "plain"]
            )

    return docs.mapInArrow(texts, "hash long, plain binary")


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    remainder_bits: int = REMAINDER_BITS,
    filter_rows: int = FILTER_ROWS,
) -> DataFrame:
    """Per input row: ``doc_id``, ``keep_id`` (the id of the row that stays of
    all rows of equal text), ``group_size``, ``kept`` and ``digest`` (SHA-256
    of the normalised text). Texts are equal if they are the same bytes once
    the characters \\x20 and \\x09-\\x0D are deleted. The row of most code
    points in its whole text stays, of these that of the smallest id.

    A null text counts as empty; empty texts and texts of white space only
    are equal to each other. A null id comes after all others, and its group's
    keep_id may be null. Of rows that repeat an id and a length in a group,
    exactly one is kept. An empty table gives no rows; other columns are not
    read. A very long text is one value in one task's memory; the digest
    names a text only after its bytes were compared.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = written(described(docs), "described")
    n = rows.count()
    bits = min(64, max(1, n).bit_length() + remainder_bits)
    slices = 1 << min(bits - 1, (max(1, n) // filter_rows).bit_length())
    repeated = written(repeated_fingerprints(rows, bits, slices, filter_rows), "repeated")

    # Grouping by the bytes themselves compares them; copies are combined in each task before the shuffle.
    wanted, many = repeated.select(F.shiftleft("print", 64 - bits)), repeated.count()
    texts = may_be_in(normalised_texts(docs.select("text")), "hash", wanted, many, bits)
    verified = written(
        texts.groupBy("plain").agg(F.count("*").alias("size")).select(F.unhex(F.sha2("plain", 256)).alias("digest"), "size"),
        "verified",
    )
    first = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    candidates = may_be_in(rows, "hash", wanted, many, bits)
    groups = candidates.groupBy("digest").agg(first, F.count("*").alias("n")).join(verified, "digest")
    size = F.when(F.col("n") == F.col("size"), F.col("n")).otherwise(F.raise_error(F.lit("texts of one digest differ")))
    groups = written(
        groups.where("n > 1 or size > 1").select(
            "digest", size.cast("long").alias("size"), F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row")
        ),
        "groups",
    )
    alone = F.col("size").isNull()
    return rows.join(groups, "digest", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("first_row"))).alias("kept"),
        "digest",
    )
