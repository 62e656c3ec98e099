"""Near-duplicate embeddings by spherical-cap filters.

Filter directions are CODES structured product codes: after a random
rotation a vector has two halves, each half a codebook of random unit
vectors, and every pair of codewords is one direction. A vector belongs to
the filters whose direction it exceeds in inner product; list decoding finds
them from the two halves' scores without looking at all directions. The
caps' height is calibrated on random vectors of the same dimension (not on
the data) so that a vector has FILTERS of each code on average; two random
vectors at cosine 0.9 then share a filter with a chance of about 0.97 in 64
dimensions (a test measures it), closer ones with a higher one.

Vectors are joined on their filters and verified with the exact cosine in
double precision. Equal vectors are one class. A filter's members are
compared in tiles of at most TILE x TILE, so a filter that a third of all
vectors share becomes many tasks. No pairs leave a tile: each tile hands on
a link count per vector (a pair counts only in the smallest filter that
both have) and one edge per vector to the root of its component there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import components, written

COSINE = 0.9
#: Codes, codewords of each half, and a vector's filters of one code on average.
CODES = 8
CODEWORDS = 128
FILTERS = 3
TILE = 1024
SEED = 77


@cache
def code(dim: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rotation, the two halves' codebooks and the least score sum."""
    size = max(16, dim + dim % 2)
    half = size // 2
    random = np.random.default_rng([SEED, dim, number])
    rotation = np.linalg.qr(random.standard_normal((size, size)))[0][:dim]
    books = random.standard_normal((2, CODEWORDS, half))
    books /= np.linalg.norm(books, axis=2, keepdims=True)
    trial = random.standard_normal((500, size))
    trial /= np.linalg.norm(trial, axis=1, keepdims=True)
    sums = np.concatenate(
        [np.add.outer(a, b).ravel() for a, b in zip(trial[:, :half] @ books[0].T, trial[:, half:] @ books[1].T)]
    )
    return rotation, books[0], books[1], float(np.partition(sums, -FILTERS * len(trial))[-FILTERS * len(trial)])


def decode(unit: np.ndarray) -> list[np.ndarray]:
    """Sorted filters of each row of ``unit`` (unit vectors)."""
    out: list[list[np.ndarray]] = [[] for _ in unit]
    for number in range(CODES):
        rotation, first, second, least = code(unit.shape[1], number)
        turned = unit @ rotation
        half = turned.shape[1] // 2
        for found, a, b in zip(out, turned[:, :half] @ first.T, turned[:, half:] @ second.T):
            i, j = np.flatnonzero(a >= least - b.max()), np.flatnonzero(b >= least - a.max())
            x, y = np.nonzero(np.add.outer(a[i], b[j]) >= least)
            found.append((number * CODEWORDS + i[x]) * CODEWORDS + j[y])  # rising: number, i and j are
    return [np.concatenate(found).astype(np.int32) for found in out]


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length 1."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _valid(value, kind: type) -> np.ndarray | None:
    if not value or None in value:
        return None
    v = np.array(value, kind)
    return v if np.isfinite(v).all() and v.any() else None


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, tile: int = TILE
) -> DataFrame:
    """Per input row: ``n_links`` (other rows whose cosine with it is found to
    be at least ``cosine``), ``component_id`` (the smallest id that links
    reach, its own included) and ``kept`` (it is that smallest).

    A vector that is null, empty, zero, or holds null or non-finite
    components is linked with nothing: 0 links, its own component, kept.
    Vectors of different lengths are not linked. A row without an id takes
    no part (0 links, null component, kept). Rows that repeat an id count as
    vectors of their own. Other columns are not read; an empty table gives
    no rows.
    """
    kind = np.float32 if vectors.schema[embedding].dataType.simpleString() == "array<float>" else np.float64
    vectors = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<float>" if kind == np.float32 else "array<double>").alias("embedding"),
    )

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            found = [
                _valid(v, kind) if i is not None else None for i, v in zip(ids, batch.column("embedding").to_pylist())
            ]
            filters: list[np.ndarray | None] = [None] * len(ids)
            for dim in {len(v) for v in found if v is not None}:
                at = [k for k, v in enumerate(found) if v is not None and len(v) == dim]
                for k, own in zip(at, decode(_unit(np.stack([found[k] for k in at])))):
                    filters[k] = own
            vector = [None if v is None else v.tobytes() for v in found]
            of_dim = CODES * CODEWORDS * CODEWORDS
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([None if v is None else xxhash.xxh3_128_digest(v) for v in vector], pa.binary()),
                    pa.array(vector, pa.binary()),
                    pa.array([None if f is None else f.tobytes() for f in filters], pa.binary()),
                    pa.array(
                        [None if f is None else len(v) * of_dim + f.astype(np.int64) for v, f in zip(found, filters)],
                        pa.list_(pa.int64()),
                    ),
                ],
                names=["vec_id", "digest", "vector", "filters", "each"],
            )

    ready = written(
        vectors.mapInArrow(prepare, "vec_id long, digest binary, vector binary, filters binary, each array<long>"), "caps"
    )
    classes = ready.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = written(
        ready.join(classes, "digest").where("vec_id = rep").dropDuplicates(["digest"]).select("rep", "copies", "vector", "filters", "each"),
        "caps-reps",
    )
    members = reps.select("rep", F.explode("each").alias("filter"))
    sizes = members.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    dealt = (
        members.join(sizes, "filter")
        .withColumn("tiles", tiles)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("filter", "rep", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
        .join(reps.select("rep", "copies", "vector", "filters"), "rep")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile; a tile's rows may span two batches."""
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            key = np.stack([rows[c].to_numpy() for c in ("filter", "lo", "hi")])
            begin = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            yield from _links(rows.slice(0, begin[-1]), begin[:-1], cosine, kind)
            held = rows.slice(begin[-1])
        if held is not None and held.num_rows:
            yield from _links(held, np.zeros(1, np.int64), cosine, kind)

    found = (
        dealt.repartition("filter", "lo", "hi")
        .sortWithinPartitions("filter", "lo", "hi")
        .mapInArrow(verify, "rep long, links long, root long")
    )
    found = written(found.groupBy("rep", "root").agg(F.sum("links").alias("links")), "caps-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "caps")
    of_rep = classes.join(links, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    component = F.coalesce("component_id", "vec_id")
    return ready.select("vec_id", "digest").join(of_rep, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(rows: pa.Table, begin: np.ndarray, cosine: float, kind: type) -> Iterator[pa.RecordBatch]:
    """The links of each tile in ``rows``; tiles begin at ``begin``."""
    if not len(begin):
        return
    reps, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
    filter_, mine, lo, hi = (rows[c].to_numpy() for c in ("filter", "mine", "lo", "hi"))
    vectors, filters = rows["vector"].to_pylist(), rows["filters"].to_pylist()
    out: list[list[np.ndarray]] = [[], [], []]
    for i, j in zip(begin.tolist(), [*begin[1:].tolist(), rows.num_rows]):
        if j - i < 2:
            continue
        x = _unit(np.frombuffer(b"".join(vectors[i:j]), kind).reshape(j - i, -1))
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        if lo[i] != hi[i]:
            linked &= mine[i:j, None] != mine[None, i:j]
        if not linked.any():
            continue
        some = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(some, some)]
        own = [np.frombuffer(filters[i + k], np.int32) for k in some]
        here = filter_[i] % (CODES * CODEWORDS * CODEWORDS)
        less = [f[: np.searchsorted(f, here)] for f in own]
        if sum(map(len, less)):
            names, at = np.unique(np.concatenate(less), return_inverse=True)
            has = np.zeros((len(some), len(names)), np.float32)
            has[np.repeat(np.arange(len(some)), [len(f) for f in less]), at] = 1
            linked &= has @ has.T == 0  # a smaller filter that both have counts the pair
        ids, weight = reps[i:j][some], copies[i:j][some]
        root = ids.copy()
        while True:
            nearer = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (nearer == root).all():
                break
            root = nearer
        out[0].append(ids)
        out[1].append(linked @ weight)
        out[2].append(root)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["rep", "links", "root"])
