"""Ranked lexical search for many items at once.

All items of a block are answered by one pass over the documents. Their
terms are one vocabulary; a document is reduced to how often it has each of
them. Items share much of their work, which a graph of term sets makes
explicit:

1. Terms that exactly the same items hold, equally often, form one set.
2. The pair of sets that most items hold together becomes a new set, and
   these items hold it in place of the two; so on while two items share one.
3. What an item then still holds is added up one by one.

Per block of documents the sum of every set of step 1 is materialised once,
then each set of steps 2 and 3 is the sum of two others, level by level, so
a partial sum that many items need is computed once for all of them. An
item's scores are the last of its sets.

Each task keeps an item's best documents only; these are ranked in two
steps (parts of tasks, then all), so no group grows with the corpus as a
whole. Collection statistics cover all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import written

#: Items, different terms and bytes of terms of one pass (one item at least): what is broadcast lies below them.
BLOCK_ITEMS, BLOCK_TERMS, BLOCK_BYTES = 4096, 32_768, 4 << 20
#: Sums that a task holds at once (documents of a batch x sets), 8 bytes each.
HELD_SUMS = 1 << 21
#: Sets of an item, those in most items first, whose pairs are looked at; decides what is shared, never a score.
PAIRED_SETS = 24
#: Parts of tasks whose best are ranked first.
RANK_PARTS = 64

#: Fixed values of the score.
SCALE, WEIGHT, LENGTH, SHARE = 1_000_000_000, 12, 25, 100

_TERM = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()  # of bytes: A-Z only


def terms(text: str | None) -> list[bytes]:
    """ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_TERM).split()


class Plan:
    """The vocabulary of some items and the graph of their shared sums."""

    def __init__(self, items: list[Counter[bytes]]):
        holders: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(items):
            for term, times in item.items():
                holders[term].append((i, times))
        self.vocabulary = {t: k for k, t in enumerate(holders)}
        #: Step 1: a set's number for each term. Terms that an item repeats are in a set once for each time.
        of_signature: dict[tuple[int, ...], int] = {}
        pairs = []
        for term, held in holders.items():
            for time in range(max(times for _, times in held)):
                signature = tuple(i for i, times in held if times > time)
                pairs.append((self.vocabulary[term], of_signature.setdefault(signature, len(of_signature))))
        self.sets = len(of_signature)
        self.term_sets: list[list[int]] = [[] for _ in self.vocabulary]
        for term_number, set_number in pairs:
            self.term_sets[term_number].append(set_number)
        self.sums: list[tuple[int, int]] = []
        self.tops = self._share(len(items), of_signature)
        self.levels = self._levels()

    def _new(self, a: int, b: int) -> int:
        self.sums.append((a, b))
        return self.sets + len(self.sums) - 1

    def _share(self, n: int, signatures: dict[tuple[int, ...], int]) -> list[int]:
        """Steps 2 and 3; the last set of each item, -1 for an item without terms."""
        held: list[set[int]] = [set() for _ in range(n)]
        for signature, number in signatures.items():
            for i in signature:
                held[i].add(number)
        width = Counter(s for sets in held for s in sets)
        together: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, sets in enumerate(held):
            shared = heapq.nsmallest(PAIRED_SETS, (s for s in sets if width[s] > 1), key=lambda s: (-width[s], s))
            for pair in combinations(sorted(shared), 2):
                together[pair].add(i)
        queue = [(-len(found), pair) for pair, found in together.items() if len(found) > 1]
        heapq.heapify(queue)
        while queue:
            count, (a, b) = heapq.heappop(queue)
            found = {i for i in together[a, b] if a in held[i] and b in held[i]}
            if len(found) < 2:
                continue
            if len(found) < -count:  # some items have taken one of the two into another set
                heapq.heappush(queue, (-len(found), (a, b)))
                continue
            new = self._new(a, b)
            beside: dict[int, set[int]] = defaultdict(set)
            for i in found:
                held[i] -= {a, b}
                for other in heapq.nsmallest(PAIRED_SETS, (s for s in held[i] if width[s] > 1), key=lambda s: (-width[s], s)):
                    beside[other].add(i)
                held[i].add(new)
            width[new] = len(found)
            for other, some in beside.items():
                if len(some) > 1:
                    together[other, new] = some
                    heapq.heappush(queue, (-len(some), (other, new)))
        tops = []
        for sets in held:
            rest = sorted(sets)
            while len(rest) > 1:  # pairwise, so the graph stays shallow
                rest = [self._new(*rest[k : k + 2]) if k + 1 < len(rest) else rest[k] for k in range(0, len(rest), 2)]
            tops.append(rest[0] if rest else -1)
        return tops

    def _levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        depth = [0] * self.sets
        by_depth: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, (a, b) in enumerate(self.sums):
            depth.append(1 + max(depth[a], depth[b]))
            by_depth[depth[-1]].append((self.sets + k, a, b))
        return [tuple(np.array(c) for c in zip(*by_depth[d])) for d in sorted(by_depth)]

    def scores(self, found: np.ndarray, doc: np.ndarray, values: np.ndarray, docs: int) -> np.ndarray:
        """Items x documents; ``found``, ``doc`` and ``values`` give the value
        of a term in a document."""
        sums = np.zeros((self.sets + len(self.sums) + 1, docs), np.int64)  # the last row, -1, stays 0
        sizes = self._sizes[found]
        at = np.repeat(self._starts[found], sizes) + _counted(sizes)
        np.add.at(sums, (self._flat[at], np.repeat(doc, sizes)), np.repeat(values, sizes))
        for to, a, b in self.levels:
            sums[to] = sums[a] + sums[b]
        return sums[self._tops]

    def ready(self) -> Plan:
        self._sizes = np.array([len(s) for s in self.term_sets], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._flat = np.array([s for sets in self.term_sets for s in sets], np.int64)
        self._tops = np.array(self.tops, np.int64)
        return self


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def term_frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """``docs`` (doc_id, text) -> ``n`` terms, and the numbers and frequencies
    of those in the broadcast vocabulary."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            n, found, times = [], [], []
            for value in batch.column("text"):
                words = terms(value.as_py())
                counts = Counter(map(number, words))
                counts.pop(None, None)
                n.append(len(words))
                found.append(list(counts))
                times.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    return docs.mapInArrow(reduce, "doc_id long, n long, terms array<int>, times array<long>")


def length_factor(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    if int(n.max(initial=0)) * documents * LENGTH < 1 << 63:
        return SHARE - LENGTH + LENGTH * n * documents // max(1, total)
    return np.array([SHARE - LENGTH + LENGTH * x * documents // total for x in n.tolist()], np.int64)


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.least = np.ones(items, np.int64)
        self.rows = [np.empty(0, np.int64)] * 4  # item, score, id is null, id

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        new = item, scores[item, doc], null[doc], ids[doc]
        self.rows = [np.concatenate(pair) for pair in zip(self.rows, new)]
        if len(self.rows[0]) > 4 * self.k * self.items:
            self.cut()

    def cut(self) -> None:
        item, score, null, ids = self.rows
        order = np.lexsort((ids, null, -score, item))
        place = _counted(np.bincount(item, minlength=self.items))
        order = order[place < self.k]
        self.rows = [r[order] for r in self.rows]
        item, score = self.rows[:2]
        full = np.flatnonzero(np.bincount(item, minlength=self.items) == self.k)
        ends = np.searchsorted(item, full, side="right") - 1
        self.least[full] = score[ends]


def _search(docs: DataFrame, ids: list[int | None], items: list[Counter[bytes]], k: int) -> DataFrame:
    """One block of items over all documents."""
    spark = docs.sparkSession
    plan = Plan(items)
    counted = written(term_frequencies(docs, spark.sparkContext.broadcast(plan.vocabulary)), "frequencies")
    size = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    rows = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most one a term of the block
    weights = np.zeros(len(plan.vocabulary), np.int64)
    for r in rows:
        weights[r.term] = math.floor(1000 * math.log((2 * size.n + 2) / (2 * r["count"] + 1)))
    shared = spark.sparkContext.broadcast((plan, weights, size.n, size.total))
    sets = plan.sets + len(plan.sums) + 1
    step = max(1, HELD_SUMS // sets)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights, documents, total = shared.value
        plan.ready()
        best = Best(len(plan.tops), k)
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                found, times = batch.column("terms"), batch.column("times")
                n = batch.column("n").to_numpy()
                m = length_factor(n, documents, total)
                tf = times.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
                term = found.flatten().to_numpy(zero_copy_only=False)
                value = weights[term] * (SCALE * tf // (1000 * tf + WEIGHT * m[doc]))
                doc_ids = batch.column("doc_id")
                null = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                numbers = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
                best.add(plan.scores(term, doc, value, batch.num_rows), numbers, null)
        best.cut()
        item, score, null, numbers = best.rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item), pa.array([ids[i] for i in item.tolist()], pa.int64()),
                pa.array(numbers, pa.int64(), mask=null.astype(bool)), pa.array(score),
            ],
            names=["item", "item_id", "doc_id", "score"],
        )

    found = counted.mapInArrow(rank, "item long, item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(RANK_PARTS)).alias("_part")
    parts = Window.partitionBy("item", "_part").orderBy(*order)
    found = found.select("*", part).withColumn("_place", F.row_number().over(parts)).where(F.col("_place") <= k)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def blocks_of(items: DataFrame, most_items: int, most_terms: int, most_bytes: int) -> Iterator[tuple[list, list]]:
    """Items (id, text) as ids and their terms, so many at once; they come
    to the driver one partition at a time."""
    ids, counts, seen, size = [], [], set(), 0
    for row in items.toLocalIterator():
        own = Counter(terms(row.text))
        new = own.keys() - seen
        if ids and (len(ids) == most_items or len(seen) + len(new) > most_terms or size + sum(map(len, new)) > most_bytes):
            yield ids, counts
            ids, counts, seen, size, new = [], [], set(), 0, own.keys()
        ids.append(row.id)
        counts.append(own)
        size += sum(map(len, new))
        seen |= new
    if ids:
        yield ids, counts


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_items: int = BLOCK_ITEMS,
    most_terms: int = BLOCK_TERMS,
    most_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item the ``k`` documents of
    highest score above 0, by the weights w = floor(1000 ln((2N+2)/(2df+1))),
    of equal ones those of smaller id. All documents are read and count in N,
    L and df, in blocks of items: one pass over the documents a block.

    A null or empty text has no terms: such a document is never found, and
    such an item finds nothing. Rows that repeat a document are documents of
    their own, rows that repeat an item are answered each. A document without
    an id comes after all others of its score; an item without one keeps the
    null. An empty table of either kind gives no rows. Other columns are not
    read. A very long text is one row in one worker's memory.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    result = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for ids, counts in blocks_of(items, most_items, most_terms, most_bytes):
        result = result.unionByName(_search(docs, ids, counts, k))
    return result
