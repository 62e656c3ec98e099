"""Exact top-k and near-duplicate embeddings against all pairs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailflow.llm import caps, knn

CLASHING = ("dim", "cell", "grp", "rep", "whole", "score", "rank", "filter", "links", "asks", "digest")
VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, schema=VECTORS):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], schema)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


ODD = [
    (900, None), (950, []), (1000, [0.0] * 8), (1050, [1.0, None] + [0.5] * 6), (1100, [math.nan] + [0.5] * 7), (1150, [math.inf] * 8),
    (None, [0.5] * 8), (1200, [0.25] * 6), (1250, [0.25] * 6), (1300, [0.5] * 8), (1301, [0.5] * 8),
]


def vectors(n=400, dim=8, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((6, dim))
    rows = centres[rnd.integers(0, 6, n)] + 0.1 * rnd.standard_normal((n, dim))
    rows[n // 2 : n // 2 + 30] = rows[0]  # copies
    return [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(rows)]


def plain_top_k(rows, k, scale=256):
    whole = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if i is not None and v is not None and None not in v and all(map(math.isfinite, v))
    ]
    out = Counter()
    for i, q in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
        out.update((i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], 1))
    return out


@pytest.mark.parametrize("kw", [{}, {"pivots": 3, "query_groups": 2, "data_block": 20}, {"k": 1}, {"k": 1000}])
def test_top_k_equals_all_pairs(spark, kw):
    rows = [*vectors(), *ODD, (50, vectors()[50][1]), (100, [0.1] * 8)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = knn.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, **kw).collect()
    assert Counter(map(tuple, got)) == plain_top_k(rows, kw.get("k", 5))


@pytest.mark.parametrize("bits", [29, 40])
def test_top_k_beyond_exact_doubles(spark, bits):
    """Scores of 2^60 need whole numbers; those of 2^82 are held at 63 bits."""
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.integers(-(2**bits), 2**bits, 4)]) for i in range(60)]
    docs = frame(spark, rows, "vec_id long, embedding array<double>, label int")
    got = Counter(map(tuple, knn.top_k(docs, F.col("vec_id") % 50 == 0, scale=1).collect()))
    if bits == 29:
        assert got == plain_top_k(rows, 5, 1)
    else:
        assert {s for *_, s in got} == {2**63 - 1} and len(got) == 10


@pytest.mark.parametrize("run", [lambda d: knn.top_k(d, F.col("vec_id") % 50 == 0), caps.near_vectors])
def test_empty_tables_give_no_rows(spark, run):
    assert run(frame(spark, [])).collect() == []


def plain_links(rows, cosine):
    unit = []
    for i, v in rows:
        ok = i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
        unit.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    links, parent = [0] * len(rows), {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a], links[b] = links[a] + 1, links[b] + 1
                x, y = sorted((root(rows[a][0]), root(rows[b][0])))
                parent[y] = x
    return Counter((i, n, root(i), i is None or root(i) == i) for (i, _), n in zip(rows, links))


@pytest.mark.parametrize("tile", [1024, 10])
def test_near_vectors_of_tight_groups_equal_all_pairs(spark, tile):
    """Groups of copies and of vectors near 0.99: no link is missed, and none counts twice."""
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((20, 64))
    rows = [(i, (centres[i % 20] + 0.05 * rnd.standard_normal(64)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(500 + i, rnd.standard_normal(64).astype(np.float32).tolist()) for i in range(100)]
    rows += [(i, v) for i, v in ODD] + [(7, rows[7][1])]
    got = caps.near_vectors(frame(spark, rows), tile=tile).collect()
    assert Counter(map(tuple, got)) == plain_links(rows, 0.9)


def test_random_pairs_at_the_threshold_share_a_filter():
    rnd = np.random.default_rng(3)
    for dim, cosine, least in ((64, 0.9, 0.95), (64, 0.95, 0.97), (16, 0.9, 0.9), (128, 0.9, 0.93)):
        x, y = rnd.standard_normal((2, 1000, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.linalg.norm(y, axis=1, keepdims=True)
        near = cosine * x + math.sqrt(1 - cosine**2) * y
        found = [len(np.intersect1d(a, b)) > 0 for a, b in zip(caps.decode(x), caps.decode(near))]
        assert np.mean(found) >= least, (dim, cosine, np.mean(found))


def test_listed_filters_are_all_those_exceeded():
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((20, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for row, listed in zip(x, caps.decode(x)):
        every = []
        for number in range(caps.CODES):
            rotation, first, second, least = caps.code(24, number)
            turned = row @ rotation
            hit = np.add.outer(first @ turned[:12], second @ turned[12:]) >= least
            every += (np.flatnonzero(hit) + number * caps.CODEWORDS**2).tolist()
        assert listed.tolist() == every
