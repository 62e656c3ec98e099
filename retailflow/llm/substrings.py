"""Removal of passages that repeat across documents.

Every window of ``width`` consecutive words gets a Rabin-Karp hash (a
polynomial of 64-bit word hashes modulo 2^64, from prefix sums). Documents
are cut into blocks of neighbouring ids, in id order. A block sends each
of its different window hashes once, dealt by hash range into buckets; a
bucket counts in which blocks a hash occurs and answers each block which of
its hashes an earlier block has too. As blocks are ordered by id, that is
all a block needs: windows of an earlier block are removed, and repeats
inside the block are settled there. Repeated windows merge into maximal
intervals of words, which are cut out.

What is shuffled: the texts once (both uses read the same exchange), one
compressed hash per different window and block (about 6 bytes), and one
bit per hash back. A passage that a third of all documents share is one
hash per window and block, however many documents have it: groups grow
with the number of blocks, not with the copies. Two different windows take
each other's place with a chance of 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import WordHashes

WIDTH = 13
DOCS_PER_BLOCK = 2048
#: Bounds that the driver holds; blocks beyond it are quantiles within these.
COARSE = 4096

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)

OUT = "doc_id long, n_words long, n_removed long, removed array<struct<first:long,end:long>>, kept string"
_SPAN = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def in_blocks(docs: DataFrame, docs_per_block: int = DOCS_PER_BLOCK, coarse: int = COARSE) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with a ``block`` number that rises with doc_id,
    and about how many blocks there are. Equal ids share a block. Rows
    without an id get negative numbers, dealt by their text."""
    n = docs.count()
    blocks = max(1, -(-n // docs_per_block))
    cells = min(blocks, coarse)
    subs = -(-blocks // cells)
    id_ = F.col("doc_id").cast("double")
    bounds = docs.select(id_.alias("id")).approxQuantile("id", [i / cells for i in range(1, cells)], 0.2 / cells) if cells > 1 else []
    cell = F.lit(0.0)
    if bounds := sorted(set(bounds)):
        docs = Bucketizer(
            splits=[-np.inf, *bounds, np.inf], inputCol="_id", outputCol="_cell", handleInvalid="keep"
        ).transform(docs.withColumn("_id", id_))
        cell = F.col("_cell")
    block = cell.cast("long") * subs
    if subs > 1:  # at most coarse * subs bounds, 8 bytes each
        inner = docs.groupBy(cell.alias("_of")).agg(
            F.percentile_approx(id_, F.lit([i / subs for i in range(1, subs)]), F.lit(8 * subs)).alias("_bounds")
        )
        docs = docs.join(F.broadcast(inner), cell == F.col("_of"), "left")  # rows without an id have no cell
        block = block + F.size(F.filter("_bounds", lambda b: b < id_))
    loose = -1 - F.pmod(F.xxhash64("text"), F.lit(blocks))
    return docs.select(F.when(F.col("doc_id").isNull(), loose).otherwise(block).cast("long").alias("block"), "doc_id", "text"), blocks


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(16, n.bit_length())
            ones = np.ones(size, np.uint64)
            ones[1:] = BASE
            cls.up = np.multiply.accumulate(ones)
            ones[1:] = _INVERSE
            cls.down = np.multiply.accumulate(ones)
        return cls.up[:n], cls.down[:n]


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` word hashes."""
    n = len(words)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = Powers.of(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(words * down, out=prefix[1:])
    return (prefix[width:] - prefix[:-width]) * up[width - 1 :]


_HASHES = WordHashes()


def _hashed(text: pa.ChunkedArray, width: int) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words and window hashes of each text."""
    words = [t.as_py().encode().split() if t.is_valid else [] for t in text]  # bytes split at \\x20 and \\x09-\\x0D only
    return words, [rolling(np.fromiter(map(_HASHES.__getitem__, w), np.uint64, len(w)), width) for w in words]


def _buckets(sorted_hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of equal hash ranges that occur, and where each one begins."""
    bucket = ((sorted_hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.unique(bucket, return_index=True)


def _shrunk(sorted_hashes: np.ndarray) -> bytes:
    """Differences, byte by byte of equal weight, compressed."""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _grown(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    docs_per_block: int = DOCS_PER_BLOCK,
    coarse: int = COARSE,
) -> DataFrame:
    """Per input row: ``n_words``, ``n_removed``, the ``removed`` intervals of
    word numbers (maximal, end exclusive) and the ``kept`` words joined by
    one space. A word goes if a window over it also starts in a document
    with a smaller id; all windows are those of the input.

    Null text has no words; a text shorter than a window keeps all. A row
    without an id takes no part and keeps all its words. Rows that share an
    id do not count against each other, but do against larger ids (they meet
    in one block, so ids are taken to be nearly unique). An empty table
    gives no rows; other columns are not read. A block's texts are in memory
    of one task together.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks, n = in_blocks(docs, docs_per_block, coarse)

    def send(block: tuple, rows: pa.Table) -> pa.Table:
        """A block's different window hashes, compressed, by bucket."""
        out: dict[str, list] = {"bucket": [], "block": [], "hashes": []}
        if block[0].as_py() >= 0:
            hashes = np.unique(np.concatenate([np.empty(0, np.uint64), *_hashed(rows["text"], width)[1]]))
            found, begin = _buckets(hashes, n)
            for bucket, part in zip(found.tolist(), np.split(hashes, begin[1:])):
                if len(part):
                    out["bucket"].append(bucket)
                    out["block"].append(block[0].as_py())
                    out["hashes"].append(_shrunk(part))
        return pa.table(out, pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary())]))

    def answer(bucket: tuple, rows: pa.Table) -> pa.Table:
        """One bit per hash that a block sent: does an earlier block have it?"""
        order = np.argsort(rows["block"].to_numpy(), kind="stable")
        blobs = rows["hashes"].to_pylist()
        parts = [_grown(blobs[i]) for i in order]
        repeats = np.ones(sum(map(len, parts)), bool)
        repeats[np.unique(np.concatenate(parts), return_index=True)[1]] = False
        bits = np.split(repeats, np.cumsum([len(p) for p in parts])[:-1])
        some = [(i, b) for i, b in zip(order, bits) if b.any()]
        return pa.table(
            {
                "block": pa.array([rows["block"][int(i)].as_py() for i, _ in some], pa.int64()),
                "bucket": pa.array([bucket[0].as_py()] * len(some), pa.int64()),
                "bits": pa.array([np.packbits(b).tobytes() for _, b in some], pa.binary()),
            }
        )

    def cut(block: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id") if rows.num_rows else rows
        ids = rows["doc_id"].to_pylist()
        words, windows = _hashed(rows["text"], width)
        flat = np.concatenate([np.empty(0, np.uint64), *windows])
        gone = np.zeros(len(flat), bool)
        if rows.num_rows and block[0].as_py() >= 0:
            hashes, first, which = np.unique(flat, return_index=True, return_inverse=True)
            owner = np.repeat(np.array(ids, np.int64), [len(w) for w in windows])
            gone = owner[first][which] < owner
            earlier = np.zeros(len(hashes), bool)
            found, begin = _buckets(hashes, n)
            ends = np.append(begin[1:], len(hashes))
            at = {b: slice(i, j) for b, i, j in zip(found.tolist(), begin.tolist(), ends.tolist())}
            for bucket, bits in zip(answers["bucket"].to_pylist(), answers["bits"].to_pylist()):
                s = at[bucket]
                earlier[s] = np.unpackbits(np.frombuffer(bits, np.uint8), count=s.stop - s.start).astype(bool)
            gone |= earlier[which]
        out: list[list] = [[], [], [], []]
        end = 0
        for w, h in zip(words, windows):
            begin, end = end, end + len(h)
            covered = np.zeros(len(w) + 1, np.int32)
            starts = np.flatnonzero(gone[begin:end])
            covered[starts] += 1
            covered[starts + width] -= 1
            covered = np.cumsum(covered) > 0
            edges = np.flatnonzero(np.diff(covered, prepend=False)) if len(starts) else []
            out[0].append(len(w))
            out[1].append(int(covered.sum()))
            out[2].append([{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
            out[3].append(b" ".join(w if not len(starts) else [x for x, c in zip(w, covered) if not c]).decode())
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(out[0], pa.int64()),
                "n_removed": pa.array(out[1], pa.int64()),
                "removed": pa.array(out[2], _SPAN),
                "kept": pa.array(out[3], pa.string()),
            }
        )

    sent = blocks.groupBy("block").applyInArrow(send, "bucket long, block long, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "block long, bucket long, bits binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, OUT)
