"""Alignment of two tokenizers over the same texts.

Both tokenizers cut a text into byte ranges; where a token of each ends at
the same byte, the text is cut into groups. The common ends of the two
sorted lists of ends are found by galloping: the shorter list drives, and
each of its ends is sought in the longer list by steps that double, then by
binary search between the last two (many ends at once, in step). The
positions of a common end in both lists cut the groups, and the differences
between neighbouring positions give the ranges of tokens that overlap.

Texts are first cut where both tokenizers cut whatever comes before and
after: between pre-tokens of the byte-level vocabulary whose meeting
characters stand next to each other in no piece of the other vocabulary.
Such a cut is a common end, so a text's groups are those of its parts in
order, and a part's alignment is kept by the worker for the next text that
has it. Where the fast split does not hold, parts are cut at single spaces
before words only, which is a cut for both whatever the characters.

Texts are encoded once: what each document has is written as a table, with
its links as pairs of ids. How often two tokens end together is then counted
over the whole table, per task first, and summed by pair. One of two tokens
that end together ends with the other's bytes, so the pairs are bounded by
the two vocabularies (``most_pairs``: about a million), not by the corpus,
and the counts are broadcast under that bound.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.alphabet import BYTE_LEVEL, CONTRACTED_LETTER, LIMIT, plain
from retailflow.llm.common import CACHED_CHARS, written

#: Parts whose alignment a worker keeps: so many lately met, and as many from before.
KEPT_PARTS = 60_000
#: Different parts that are encoded together, and parts to a string.
ENCODED, STRUNG = 8192, 64
#: A space before a word and after a word: a cut for both tokenizers.
_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")
_CONTRACTED = re.compile(CONTRACTED_LETTER)
#: Stands between parts in a string, where it is always a token of its own for both.
_MARK = "\n"
_STRINGABLE = re.compile(r" ?\S(?:[^\n]*\S)?")

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>"


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with a[i] == b[j] in two strictly rising lists."""
    if len(a) > len(b):
        j, i = common_ends(b, a)
        return i, j
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # An end of the i-th driver is found about as far into the longer list; from there steps double either way.
    near = np.searchsorted(b, a[:: 1 << 10])  # one end in a thousand, as where to start
    low = np.repeat(near, 1 << 10)[: len(a)]
    high, step = low.copy(), 1
    behind = np.flatnonzero(b[np.minimum(high, len(b) - 1)] < a)
    while len(behind):
        low[behind] = high[behind] + 1
        high[behind] = np.minimum(high[behind] + step, len(b))
        step *= 2
        inside = behind[high[behind] < len(b)]
        behind = inside[b[high[inside]] < a[inside]]
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) >> 1
        less = b[middle] < a[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    found = np.flatnonzero((low < len(b)) & (b[np.minimum(low, len(b) - 1)] == a))
    return found, low[found]


#: How a part is aligned: tokens of both, groups, the groups printed, each with a semicolon behind, and the links'
#: id pairs a << 32 | b as bytes.
Part = tuple[int, int, int, str, bytes]


class Tokenizers:
    """Both vocabularies, read once per worker."""

    def __init__(self, a_path: str, b_path: str):
        import os

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        # The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        byte = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(hidden)}
        self.a_bytes = {i: bytes(byte.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        whole = [p.replace("▁", " ") for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i))]
        touching = {x + y for p in whole for x, y in zip(p, p[1:])}
        if any(_MARK in pair for pair in touching):
            raise ValueError("a piece of the second vocabulary holds a line feed")
        if any(y == " " and not x.isspace() for x, y in touching):
            raise ValueError("a piece of the second vocabulary holds a space after another character")
        below = list(map(chr, range(LIMIT)))
        #: Where the fast split would cut what the second vocabulary may join: looked for one by one, which is fast.
        self.joins = [p for p in touching if ord(max(p)) < LIMIT and (p.isspace() or len(BYTE_LEVEL.findall(p)) > 1)]
        self.joins += [c + " " for c in below if c.isspace()]
        self.late: dict[str, Part | None] = {}
        self.before: dict[str, Part | None] = {}
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_sizes[i] = len(t)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        (self.a_mark,), self.b_mark = self.a.encode(_MARK).ids, self.b.encode(_MARK)[-1]
        # Ids as they are printed: followed by another of the same group, or last of it.
        self.a_printed, self.b_printed = (
            np.array([[f"{i}," for i in range(n)], [f"{i}{end}" for i in range(n)]], object)
            for n, end in ((len(self.a_sizes), "|"), (len(self.b_sizes), ";"))
        )

    def fast(self, text: str) -> bool:
        """True if every cut of the fast split is one of both tokenizers."""
        if not plain(text, ()) or any(pair in text for pair in self.joins):
            return False
        return "'" not in text or not _CONTRACTED.search(text)

    def cut(self, text: str) -> list[str]:
        """The parts of a text that begins with the added space."""
        if self.fast(text):
            return BYTE_LEVEL.findall(text)
        parts = []
        for p in _BEFORE_WORD.split(text):
            parts += BYTE_LEVEL.findall(p) if self.fast(p) else [p]
        return parts

    def align(self, parts: list[str], a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> list[Part | None]:
        """``parts`` one after the other, with the ids of both and how many
        each part has. None for a part whose bytes the tokens of either do not
        give back."""
        data = "".join(parts).encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            if len(parts) == 1:
                return [None]
            i, j = np.cumsum(a_n), np.cumsum(b_n)
            cuts = zip(parts, i - a_n, i, j - b_n, j)
            return [self.align([p], a[s:t], np.array([t - s]), b[u:v], np.array([v - u]))[0] for p, s, t, u, v in cuts]
        first, second = common_ends(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[first] = b_last[second] = 1
        # The tokens of a group in print: those of the first tokenizer, then those of the second.
        a_place = np.arange(len(a)) + np.concatenate([[0], second + 1])[np.cumsum(a_last) - a_last]
        b_place = np.arange(len(b)) + (first + 1)[np.cumsum(b_last) - b_last]
        printed = np.empty(len(a) + len(b), object)
        printed[a_place], printed[b_place] = self.a_printed[a_last, a], self.b_printed[b_last, b]
        printed = printed.tolist()
        links = (a[first] << 32 | b[second]).astype("<i8").tobytes()
        a_ends, b_ends = np.cumsum(a_n), np.cumsum(b_n)
        groups = np.searchsorted(first, a_ends - 1) + 1  # each part ends at a common end
        ends, ranks = (a_ends + b_ends).tolist(), groups.tolist()
        begins, before = [0, *ends], [0, *ranks]
        return [
            (x, y, rank - r, "".join(printed[begin:end]), links[8 * r : 8 * rank])
            for x, y, rank, r, begin, end in zip(a_n.tolist(), b_n.tolist(), ranks, before, begins, ends)
        ]

    def _ids(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both for strings that a mark begins; the second tokenizer's
        space before it is cut off."""
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        b = self.b.encode(strings, num_threads=1)
        return tuple(np.fromiter(chain.from_iterable(x), np.int64) for x in (a, (y[1:] for y in b)))

    def encode(self, parts: list[str]) -> dict[str, Part | None]:
        """Parts that can be strung together are encoded many to a string."""
        found: dict[str, Part | None] = {}
        strung = [p for p in parts if _STRINGABLE.fullmatch(p)]
        for i in range(0, len(strung), ENCODED):
            some = strung[i : i + ENCODED]
            strings = [_MARK + _MARK.join(some[k : k + STRUNG]) for k in range(0, len(some), STRUNG)]
            a, b = self._ids(strings)
            sizes = []
            for ids, mark in ((a, self.a_mark), (b, self.b_mark)):
                marks = np.flatnonzero(ids == mark)
                sizes.append(np.diff(np.append(marks, len(ids))) - 1)
            a, b = a[a != self.a_mark], b[b != self.b_mark]
            found.update(zip(some, self.align(some, a, sizes[0], b, sizes[1])))
        for p in parts:
            if p not in found:
                a = np.array(self.a.encode(p, add_special_tokens=False).ids, np.int64)
                b = np.array(self.b.encode(_MARK + p)[2:], np.int64)
                found[p] = self.align([p], a, np.array([len(a)]), b, np.array([len(b)]))[0]
        return found

    def of(self, texts: list[list[str]]) -> dict[str, Part | None]:
        """The alignment of every part of a batch of texts."""
        wanted = set().union(*texts)
        late, before = self.late, self.before
        known = {p: late[p] for p in wanted if p in late}
        again = {p: before[p] for p in wanted if p not in known and p in before}
        made = self.encode([p for p in wanted if p not in known and p not in again])
        if len(late) + len(again) + len(made) > KEPT_PARTS:
            self.before, self.late = late, {}
        keep = (x for x in chain(again.items(), made.items()) if len(x[0]) <= CACHED_CHARS)
        self.late.update(islice(keep, KEPT_PARTS))
        return known | again | made


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def most_pairs(a_path: str, b_path: str) -> int:
    """How many id pairs can end together at most: of two such tokens one
    ends with the bytes of the other."""
    both = tokenizers(a_path, b_path)
    a, b = Counter(both.a_bytes.values()), Counter(both.b_bytes)
    within = sum(n * b[t[i:]] for t, n in a.items() for i in range(len(t)))
    return within + sum(n * a[t[i:]] for t, n in b.items() for i in range(1, len(t)))


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``docs`` (doc_id, text) -> what SCHEMA says: tokens, groups and links of
    each whole text, a space before it."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        for batch in batches:
            texts = [both.cut(" " + t) if t else [] for t in batch.column("text").to_pylist()]
            found, out, links = both.of(texts), [], []
            for parts in texts:
                each = list(map(found.get, parts))
                if not each or None in each:
                    out.append((0, 0, 0, ""))
                    links.append(b"")
                    continue
                n_a, n_b, n_groups, groups, pairs = zip(*each)
                printed = "".join(groups)[:-1].encode()
                out.append((sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(printed).hexdigest()))
                links.append(b"".join(pairs))
            counts = [pa.array(c, pa.int64()) for c in list(zip(*out))[:3]] if out else [pa.array([], pa.int64())] * 3
            ends = np.cumsum([0, *(len(x) // 8 for x in links)]).astype(np.int32)
            pairs = pa.array(np.frombuffer(b"".join(links), "<i8"), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), *counts, pa.array([x[3] for x in out], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pairs),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
            )

    return docs.mapInArrow(align, SCHEMA)


def link_counts(table: DataFrame) -> DataFrame:
    """``(pair, n)``: how many links of all texts hold the two ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            more, times = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            pairs, at = np.unique(np.concatenate([pairs, more]), return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, at, np.concatenate([n, times]))
            n = sums
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    return table.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignments(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per input row the alignment of the whole text, a space before it:
    ``n_a`` and ``n_b`` tokens, ``n_groups`` between common ends, ``n_links``
    (pairs of tokens that end together), ``n_best`` (links whose id pair is,
    over all texts, the most frequent of its second id, ties included),
    ``count_sum`` (of the counts of the links' pairs), the SHA-256 of the
    groups, printed ``a1,a2|b1;a3|b2``, and the ``links`` (a << 32 | b).

    A text that is null or empty, or that either tokenizer does not give
    back byte by byte, has no tokens: zeros and an empty string. A null id is
    passed through, repeated rows each count, an empty table gives no rows,
    and other columns are not read. A very long text is one row in the
    memory of one worker, with its parts.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = written(aligned(docs, a_path, b_path), "aligned")
    bound = most_pairs(a_path, b_path)
    counts = link_counts(table).orderBy("pair").limit(bound).toArrow()  # at most `bound` pairs of 16 bytes
    pairs, n = counts["pair"].to_numpy(), counts["n"].to_numpy()
    seconds = pairs & 0xFFFFFFFF
    highest = np.zeros(int(seconds.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, seconds, n)
    shared = docs.sparkSession.sparkContext.broadcast((pairs, n, n == highest[seconds]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            links = batch.column("links")
            at = np.searchsorted(pairs, links.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum([0, *links.value_lengths().to_pylist()])
            sums = (np.concatenate([[0], np.cumsum(x[at])])[ends] for x in (best.astype(np.int64), n))
            n_best, count_sum = (pa.array(np.diff(x).astype(np.int64)) for x in sums)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(batch.num_columns)), n_best, count_sum],
                names=[*batch.schema.names, "n_best", "count_sum"],
            )

    found = table.mapInArrow(measure, f"{SCHEMA}, n_best long, count_sum long")
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256", "links")
