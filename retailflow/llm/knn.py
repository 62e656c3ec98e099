"""Exact top-k search by inner product as a Voronoi kNN join.

Data and queries are grouped by their nearest pivot. Each group is
summarised by its size and radius. A query first searches its own cell,
which gives a lower bound on its k-th best score. By Cauchy and Schwarz a
data vector x of a cell with pivot p scores at most q.p + |q| |x - p|, so a
query group needs from a cell only vectors at least as far from the pivot
as the group's least demanding query asks; just those are replicated to the
group, and searched there block by block. Cells and groups are dealt in
blocks of at most DATA_BLOCK x QUERY_BLOCK vectors: a cell or a group that
holds a third of all rows becomes many tasks.

Everything the driver or a broadcast holds is bounded by the number of
pivots: the pivots, and one row per cell or per (query group, cell).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import written

SCALE = 256
K = 5
#: Pivots of the data, a sample of the vectors by the hash of their ids.
PIVOTS = 64
#: Pivots of the queries at most.
QUERY_GROUPS = 16
DATA_BLOCK = 8192
QUERY_BLOCK = 512
#: Components are held within a 63-bit integer.
LARGEST = float(1 << 62)
#: Relative slack of the bounds against rounding.
SLACK = 1e-9


def _whole(value, scale: int) -> np.ndarray | None:
    if value is None or None in value:
        return None
    v = np.array(value, np.float64)
    if not np.isfinite(v).all():
        return None
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v), -LARGEST, LARGEST)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers (as doubles), held
    within 63 bits. Below 2^53 doubles are exact, beyond it Python's integers
    are used."""
    largest = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    found = exact(a) @ exact(b).T
    return np.clip(found, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _matrix(blobs: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist())).reshape(len(blobs), -1)


def _best(queries: pa.Table, data: pa.Table, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query row: its number, ids and scores of its k best rows of
    ``data``, leaving out its own id; ties go to the smaller id."""
    if not queries.num_rows or not data.num_rows:
        return
    ids, own = data["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    table = _matrix(data["whole"])
    for at in range(0, queries.num_rows, QUERY_BLOCK):
        found = scores(_matrix(queries["whole"].slice(at, QUERY_BLOCK)), table)
        for i, row in enumerate(found):
            others = np.flatnonzero(ids != own[at + i])
            if len(others) > k:
                kth = np.partition(row[others], -k)[-k]
                others = others[row[others] >= kth]
            order = others[np.lexsort((ids[others], -row[others]))][:k]
            yield at + i, ids[order], row[order]


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and the distance to it."""
    cell = np.argmin((pivots**2).sum(axis=1) - 2 * (rows @ pivots.T), axis=1)
    return cell, np.linalg.norm(rows - pivots[cell], axis=1)


def top_k(
    vectors: DataFrame,
    is_query: F.Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    pivots: int = PIVOTS,
    query_groups: int = QUERY_GROUPS,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row for which
    ``is_query`` holds, the ``k`` highest inner products among all rows of
    other ids (all of them, if fewer), ties to the smaller id. Components are
    floor(scale * x).

    Vectors that are null, or hold null or non-finite components, and rows
    without an id take no part; vectors of different lengths are not
    compared. Components beyond 2^62 count as 2^62, and scores beyond 63
    bits as the largest. Rows that repeat an id and a vector ask once, but
    each is a candidate of others; rows that repeat an id with another vector
    ask once each. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ids = F.col(vec_id).cast("long")
    vectors = vectors.select(
        ids.alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where("vec_id is not null and embedding is not null")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_whole(v, scale) for v in batch.column("embedding").to_pylist()]
            rows = [(i, q, v) for i, q, v in zip(batch.column("vec_id").to_pylist(), batch.column("asks").to_pylist(), found) if v is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in rows], pa.int64()),
                    pa.array([q for _, q, _ in rows], pa.bool_()),
                    pa.array([len(v) for _, _, v in rows], pa.int32()),
                    pa.array([v.tobytes() for _, _, v in rows], pa.binary()),
                ],
                names=["vec_id", "asks", "dim", "whole"],
            )

    rows = written(vectors.mapInArrow(whole, "vec_id long, asks boolean, dim int, whole binary"), "knn-rows")
    by_hash = [F.xxhash64("vec_id"), F.col("vec_id")]
    sampled: dict[int, list[np.ndarray]] = {}
    for r in rows.select("dim", "whole").orderBy(*by_hash).limit(pivots).collect():
        sampled.setdefault(r.dim, []).append(np.frombuffer(bytes(r.whole)))
    centres = {dim: np.unique(np.stack(found), axis=0) for dim, found in sampled.items()}
    centres_of: Callable[[int], np.ndarray] = lambda dim: centres.get(dim, np.zeros((1, dim)))
    groups_of: Callable[[int], np.ndarray] = lambda dim: centres_of(dim)[:query_groups]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, far, group = np.zeros(len(dims), np.int32), np.zeros(len(dims)), np.zeros(len(dims), np.int32)
            blobs = batch.column("whole").to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = np.frombuffer(b"".join(blobs[i] for i in at)).reshape(len(at), -1)
                cell[at], far[at] = _nearest(own, centres_of(dim))
                group[at] = _nearest(own, groups_of(dim))[0]
            arrays = [pa.array(cell), pa.array(far), pa.array(group)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, "cell", "far", "grp"])

    cells = written(
        rows.mapInArrow(
            assign, "vec_id long, asks boolean, dim int, whole binary, cell int, far double, grp int"
        ),
        "knn-cells",
    )
    summary = cells.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
    bounds = {(r.dim, r.cell): (r.n, r.radius) for r in summary.collect()}
    sizes = spark.createDataFrame(
        [(d, c, -(-n // data_block)) for (d, c), (n, _) in bounds.items()], "dim int, cell int, blocks int"
    )
    data = cells.select("dim", "cell", "far", "vec_id", "whole").join(F.broadcast(sizes), ["dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    )
    queries = cells.where("asks").dropDuplicates(["vec_id", "whole"]).withColumn("asker", F.xxhash64("whole"))

    def bound(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        for i, _, found in _best(queries, data, k):
            if len(found) == k:
                out[0].append(queries["vec_id"][i].as_py())
                out[1].append(queries["asker"][i].as_py())
                out[2].append(int(found[-1]))
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["vec_id", "asker", "least"])

    home = queries.join(F.broadcast(sizes), ["dim", "cell"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    local = (
        home.groupBy("dim", "cell", "block")
        .cogroup(data.toDF(*data.columns).groupBy("dim", "cell", "block"))
        .applyInArrow(bound, "vec_id long, asker long, least long")
        .groupBy("vec_id", "asker")
        .agg(F.max("least").alias("least"))
    )
    asked = written(queries.join(local, ["vec_id", "asker"], "left"), "knn-asked")

    def demands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The least distance from a cell's pivot that any query of a group asks for."""
        for batch in batches:
            out: dict[tuple[int, int, int], float] = {}
            for dim, group, blob, least in zip(
                *(batch.column(c).to_pylist() for c in ("dim", "grp", "whole", "least"))
            ):
                q = np.frombuffer(blob)
                norm = np.linalg.norm(q)
                pivot_scores = centres_of(dim) @ q
                for cell, at in enumerate(pivot_scores):
                    if (dim, cell) in bounds:
                        slack = SLACK * (abs(at) + norm * bounds[dim, cell][1] + abs(least or 0)) + 1e-6
                        short = -1.0 if least is None else least - at - slack
                        need = 0.0 if short <= 0 else (short / norm if norm else np.inf)
                        out[dim, group, cell] = min(out.get((dim, group, cell), np.inf), need)
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([key[i] for key in keys], pa.int32()) for i in range(3)), pa.array([out[key] for key in keys], pa.float64())],
                names=["dim", "grp", "cell", "need"],
            )

    need = (
        asked.mapInArrow(demands, "dim int, grp int, cell int, need double")
        .groupBy("dim", "grp", "cell")
        .agg(F.min("need").alias("need"))
    )
    needed = need.collect()  # at most query groups x cells, for each length of vectors
    table = spark.createDataFrame([tuple(r) for r in needed], "dim int, grp int, cell int, need double")
    parts = asked.groupBy("dim", "grp").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts"))
    shipped = (
        data.join(F.broadcast(table), ["dim", "cell"])
        .where("far >= need")
        .join(F.broadcast(parts), ["dim", "grp"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("dim", "grp", "part", "cell", "block", "vec_id", "whole")
    )
    # Blocks of several small cells may meet in one task's block.
    chunk = F.pmod(F.xxhash64("cell", "block"), F.lit(max(1, sum(-(-n // data_block) for n, _ in bounds.values()) // 8)))
    blocks = shipped.withColumn("chunk", chunk)
    chunks = blocks.select("dim", "grp", "part", "chunk").distinct()
    asking = (
        asked.join(F.broadcast(parts), ["dim", "grp"])
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .join(chunks, ["dim", "grp", "part"])
    )

    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for i, found, points in _best(queries, data, k):
            out[0] += [queries["vec_id"][i].as_py()] * len(found)
            out[1] += [queries["asker"][i].as_py()] * len(found)
            out[2] += found.tolist()
            out[3] += points.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "asker", "vec_id", "score"])

    found = (
        asking.groupBy("dim", "grp", "part", "chunk")
        .cogroup(blocks.toDF(*blocks.columns).groupBy("dim", "grp", "part", "chunk"))
        .applyInArrow(solve, "query_id long, asker long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
