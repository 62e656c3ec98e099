"""Toxicity from two Kneser-Ney language models.

One bigram model is counted on documents labelled toxic, one on those
labelled ordinary. Both interpolate down to the same lowest order: the
continuation counts of the whole corpus, so an expression that the labelled
documents hardly show is scored through what both share and pulls to
neither side. A document's evidence is the length-normalised difference of
the two log-likelihoods; a logistic curve, fitted on labelled documents that
the models were not counted on, turns it into a probability.

The models' words are all those whose document frequency differs between the
classes; all others are one class of unknown words. A pair of words that no
labelled document has is scored from its two words alone, so a model holds two
numbers a word and one for each pair seen; it is broadcast, and texts are
scored where they are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import may_be_in, written

#: Different words, and pairs of them, that a task counts before it hands their counts on.
HELD_WORDS = 500_000
HELD_PAIRS = 2_000_000
#: Rows that the counts of a kind's pairs are brought together in.
PAIR_PARTS = 64
#: The curve is fitted to the means of the evidence that is equal to so many decimals, whose number is bounded.
CURVE_DECIMALS = 4
#: Log-likelihood ratio (in nats) from which a word's frequencies count as different.
LEAST_EVIDENCE = 8.0
#: Part of the labelled documents that fits the curve: id hashes divisible by it.
CURVE_PART = 4
DISCOUNT = 0.75

UNKNOWN, BEGIN = 0, 1
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    """Vocabulary, log-likelihood differences and curve. ``pairs`` are the
    pairs seen in labelled documents as sorted numbers (previous * words +
    word) with their differences in ``table``; that of any other pair is the
    sum of ``before[previous]`` and ``after[word]``."""

    ids: dict[str, int]
    pairs: np.ndarray
    table: np.ndarray
    before: np.ndarray
    after: np.ndarray
    slope: float
    shift: float

    def coded(self, text: str | None) -> np.ndarray:
        return _coded(self.ids, text)

    def evidence(self, text: str | None) -> float:
        """Mean difference of the log-likelihoods a word; 0 without words."""
        at = self.coded(text)
        return float(self.differences(at[:-1], at[1:]).mean(dtype=np.float64)) if len(at) > 1 else 0.0

    def differences(self, previous: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = (self.before[previous] + self.after[word]).astype(np.float32)
        if len(self.pairs):
            wanted = previous * len(self.after) + word
            place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
            seen = self.pairs[place] == wanted
            out[seen] = self.table[place[seen]]
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.evidence(text) + self.shift, -500, 500))))


def _coded(ids: dict[str, int], text: str | None) -> np.ndarray:
    found = words(text)
    out = np.full(len(found) + 1, BEGIN, np.int64)
    out[1:] = [ids.get(w, UNKNOWN) for w in found]
    return out


def is_training(doc_id: Column) -> Column:
    """Whether labels may be learnt from the document: crc32 of its id as
    text modulo 5 is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``(doc_id, text, toxic, curve)`` of all labelled documents. Several
    labels of one id count as toxic if any does; null labels do not count.
    Only documents that may have a label are shuffled to them, whatever the
    size: a bit map of the labelled ids picks them where they are read."""
    chosen = written(
        labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .where(is_training(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic")),
        "toxic-labels",
    )
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = may_be_in(texts.withColumn("_hash", F.xxhash64("doc_id")), "_hash", chosen.select(F.xxhash64("doc_id")), chosen.count())
    curve = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CURVE_PART)) == 0).alias("curve")
    return texts.join(chosen.hint("merge"), "doc_id").select("doc_id", "text", "toxic", curve)


def vocabulary(sample: DataFrame, least_evidence: float) -> dict[str, int]:
    """All words whose document frequencies differ between the classes by
    ``least_evidence`` at least, numbered from 2, the clearest first."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            every = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(every, pa.string()), *(pa.array([c[w] for w in every], pa.int64()) for c in counts)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "ordinary", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                counts[toxic].update(set(words(text.as_py())))
                if len(counts[0]) + len(counts[1]) >= HELD_WORDS:
                    yield out()
        yield out()

    documents = sample.groupBy("toxic").count().collect()
    total = {r.toxic: r["count"] for r in documents}
    n0, n1 = (float(total.get(c, 0)) for c in (False, True))
    if not n0 or not n1:
        return {}

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both = F.col("ordinary") + F.col("toxic")
    ratio = part(F.col("toxic"), both * (n1 / (n0 + n1))) + part(F.col("ordinary"), both * (n0 / (n0 + n1)))
    rows = (
        sample.where("not curve")
        .select("text", "toxic")
        .mapInArrow(frequencies, "word string, ordinary long, toxic long")
        .groupBy("word")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
        .where(ratio >= least_evidence)
        .orderBy(F.desc(ratio), "word")
        .select("word")
        .collect()
    )
    return {r.word: i + 2 for i, r in enumerate(rows)}


def pair_counts(texts: DataFrame, ids: dict[str, int]) -> DataFrame:
    """``(kind, part, pairs, n)``: word pairs of all texts by ``kind``, as
    sorted arrays of their numbers (previous * words + word) and counts, one
    row for each of PAIR_PARTS parts (of the previous words). A task adds its
    texts up before it hands anything on; there are no more pairs than words
    read, and no rows of single pairs."""
    size = len(ids) + 2
    sent = texts.sparkSession.sparkContext.broadcast(ids)
    names = ["kind", "part", "pairs", "n"]

    def rows(kind: int, pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = pairs // size % PAIR_PARTS
        order = np.argsort(part, kind="stable")
        parts, starts = np.unique(part[order], return_index=True)
        ends = np.append(starts, len(pairs)).astype(np.int32)
        columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c[order])) for c in (pairs, n)]
        if len(parts):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), kind, np.int32)), pa.array(parts.astype(np.int32)), *columns], names=names)

    def added(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every, place = np.unique(pairs, return_inverse=True)
        return every, np.bincount(place, n, len(every)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            found: dict[int, list[np.ndarray]] = {}
            for text, kind in zip(batch.column("text"), batch.column("kind").to_pylist()):
                at = _coded(sent.value, text.as_py())
                found.setdefault(kind, []).append(at[:-1] * size + at[1:])
            for kind, each in found.items():
                pairs, n = np.unique(np.concatenate(each), return_counts=True)
                old = sums.get(kind)
                sums[kind] = added(np.concatenate([old[0], pairs]), np.concatenate([old[1], n])) if old else (pairs, n)
            if sum(len(pairs) for pairs, _ in sums.values()) >= HELD_PAIRS:
                for kind, both in sums.items():
                    yield from rows(kind, *both)
                sums.clear()
        for kind, both in sums.items():
            yield from rows(kind, *both)

    def merged(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in group:
            own = [batch.column(c).flatten().to_numpy() for c in ("pairs", "n")]
            pairs, n = added(np.concatenate([pairs, own[0]]), np.concatenate([n, own[1]]))
        yield from rows(key[0].as_py(), pairs, n)

    schema = "kind int, part int, pairs array<long>, n array<long>"
    return texts.mapInArrow(count, schema).groupBy("kind", "part").applyInArrow(merged, schema)


def bigrams(texts: DataFrame, ids: dict[str, int]) -> DataFrame:
    """``(kind, previous, word, n)``: word pairs of all texts by ``kind``."""
    size = len(ids) + 2
    rows = pair_counts(texts, ids).select("kind", F.explode(F.arrays_zip("pairs", "n")).alias("p"))
    return rows.select("kind", F.expr(f"int(p.pairs div {size})").alias("previous"), F.expr(f"int(p.pairs % {size})").alias("word"), "p.n")


def kinds_before(counted: DataFrame, size: int) -> np.ndarray:
    """How many different words stand before each word, from :func:`pair_counts`."""

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, np.int64)
        for batch in batches:
            out += np.bincount(batch.column("pairs").flatten().to_numpy() % size, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array([out])], names=["kinds"])

    found = counted.select("pairs").mapInArrow(kinds, "kinds array<long>")
    return sum((np.array(r.kinds, np.float64) for r in found.toLocalIterator()), np.zeros(size))


def log_probabilities(counts: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney: log P(word | previous) from bigram counts, by
    way of the class's own continuation counts down to ``shared``."""
    kinds = (counts > 0).sum(axis=0).astype(np.float64)
    total = max(kinds.sum(), 1.0)
    lower = np.maximum(kinds - DISCOUNT, 0) / total
    lower += (1 - lower.sum()) * shared
    after = counts.sum(axis=1, keepdims=True)
    kept = np.maximum(counts - DISCOUNT, 0) / np.maximum(after, 1)
    return np.log(kept + (1 - kept.sum(axis=1, keepdims=True)) * lower)


def pair_differences(found: dict[str, np.ndarray], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``pairs, table, before, after`` of a model: :func:`log_probabilities`
    of class 1 less those of class 0, from the counts of the pairs that were
    seen (``kind``, ``previous``, ``word``, ``n``) without the table of all."""
    size = len(shared)
    key = found["previous"].astype(np.int64) * size + found["word"]
    pairs = np.unique(key)
    table, before, after = np.zeros(len(pairs)), np.zeros(size), np.zeros(size)
    for kind, sign in ((1, 1.0), (0, -1.0)):
        own = found["kind"] == kind
        previous, word, n = (found[c][own] for c in ("previous", "word", "n"))
        kinds = np.bincount(word, minlength=size).astype(np.float64)
        lower = np.maximum(kinds - DISCOUNT, 0) / max(kinds.sum(), 1.0)
        lower += (1 - lower.sum()) * shared
        kept = (n - DISCOUNT) / np.bincount(previous, n, size)[previous]
        rest = 1 - np.bincount(previous, kept, size)
        seen = np.zeros(len(pairs))
        seen[np.searchsorted(pairs, key[own])] = kept
        table += sign * np.log(seen + rest[pairs // size] * lower[pairs % size])
        before += sign * np.log(rest)
        after += sign * np.log(lower)
    return pairs, table.astype(np.float32), before, after


def curve(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through points that occur ``n``
    times each, by Newton steps, slightly held back."""
    scale = float(np.abs(x).max(initial=0.0)) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    w, hold = np.zeros(2), np.diag([1e-3, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        step = np.linalg.solve((a.T * (n * p * (1 - p))) @ a + hold, a.T @ (n * (y - p)) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int | None = None,
    least_evidence: float = LEAST_EVIDENCE,
) -> Model:
    """The models of a corpus. Vocabulary and class counts come from all
    labelled documents but those of the curve, which is fitted to all of these
    (to ``max_labelled`` of them, picked by the hash of their ids, if given);
    the shared counts come from all documents. Without labels of both classes
    there is no evidence and every score is the smoothed share of toxic
    labels, at most 1/2 - 1/(n + 3)."""
    sample = written(labelled(docs, labels, doc_id, text, label), "toxic-sample")
    ids = vocabulary(sample, least_evidence)
    size = len(ids) + 2
    if not ids:
        n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0))).first()
        share = min((toxic + 0.5) / (n + 3), 0.5 - 1 / (n + 3))
        none = np.zeros(0, np.int64)
        return Model({}, none, none.astype(np.float32), np.zeros(size), np.zeros(size), 0.0, float(np.log(share / (1 - share))))
    corpus = docs.select(F.col(text).alias("text"), F.lit(2).alias("kind"))
    shared = kinds_before(pair_counts(corpus, ids), size) + 1
    shared /= shared.sum()
    learnt = sample.where("not curve").select("text", F.col("toxic").cast("int").alias("kind"))
    rows = pair_counts(learnt, ids).toArrow()  # the pairs of known words: the model itself
    pairs, n = (rows[c].combine_chunks().flatten().to_numpy() for c in ("pairs", "n"))
    lengths = pc.list_value_length(rows["pairs"]).to_numpy()
    kinds = np.repeat(rows["kind"].to_numpy(), lengths)
    found = {"kind": kinds, "previous": pairs // size, "word": pairs % size, "n": n}
    model = Model(ids, *pair_differences(found, shared), 1.0, 0.0)
    held = sample.where("curve")
    if max_labelled is not None:
        some = held.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
        held = held.join(F.broadcast(some), "doc_id")
    held = score(held, model, keep=["toxic"], evidence=True)
    bins = held.groupBy(F.col("row.toxic").alias("toxic"), F.round("score", CURVE_DECIMALS).alias("bin"))
    sums = bins.agg(F.round(F.avg("score"), 9).alias("score"), F.count(F.lit(1)).alias("count")).orderBy("score", "toxic").collect()
    x, y, n = (np.array([r[c] for r in sums], np.float64) for c in ("score", "toxic", "count"))
    if len(set(y)) == 2:
        model.slope, model.shift = curve(x, y, n)
    return model


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, evidence: bool = False
) -> DataFrame:
    """``(row, score)``: the columns ``keep`` of each row of ``docs`` (all, if
    None) as a struct, which no name can clash with, and the probability (or
    the evidence) that its whole text is toxic.

    A null or empty text, or one without letters, has no evidence and gets
    the curve's value at 0. Repeated rows are scored each alike; an empty
    table gives no rows.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(row.alias("row"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        of = own.evidence if evidence else own.score
        for batch in batches:
            found = pa.array([of(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "score"])

    return docs.mapInArrow(scored, docs.select("row", F.lit(0.0).alias("score")).schema)
