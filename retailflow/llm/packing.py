"""Hierarchical packing of tokenised documents into context windows.

Windows come in tiers (4096, 2048, ... tokens). A document is routed to the
shortest tier that holds it (a longer one is cut into full windows of the
longest tier first, and its remainder is routed). Each tier packs its own
pieces, longest tier first: a window opens with one of the tier's pieces
and its gap is filled with pieces from the shorter tiers, whole ones while
they fit, then the head of one that is cut. So every window is exactly
full. What is left in a task at its end, less than one window, is cut at
powers of two. Windows are dealt into step groups of equal token totals.

Texts are read, tokenised and packed where they lie: nothing is shuffled
and no group is formed, so a hot source or a huge document costs only the
task that reads it. A task holds one pool of at most POOL_IDS token ids and
the longest document of its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.alphabet import WORD_LEVEL, plain
from retailflow.llm.common import CACHE_SIZE, CACHED_CHARS
from retailflow.llm.tokens import special_strings, tokenizer

TIERS = (4096, 2048, 1024, 512, 256)
#: Windows of one step group hold together so many tokens.
STEP_TOKENS = 16 * TIERS[0]
POOL_IDS = 1 << 20
#: Bytes of an id.
ID = 4

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"


#: Texts whose unknown words are encoded together.
TOGETHER = 64


def _le(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


@cache
def _word_ends(path: str) -> np.ndarray:
    """Whether an id ends a word, by id."""
    vocabulary = tokenizer(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    return ends


class WordIds(dict):
    """Words' token ids as little-endian 32-bit numbers, kept in the worker.
    When it fills up, the words met first, which the frequent ones are among,
    stay and the later ones go."""

    def __init__(self, path: str):
        self.path = path

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Encodes ``words``; returns those that are not kept."""
        tok, ends = tokenizer(self.path), _word_ends(self.path)
        new, passing = list(words), {}
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            # Words apart by spaces are encoded one by one, and each ends with an id that ends a word.
            ids = np.array(tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            at = (np.flatnonzero(ends[ids]) + 1) * ID
            if len(at) != len(part):
                raise ValueError(f"{self.path}: the vocabulary does not mark the ends of words")
            whole = ids.tobytes()
            for word, a, b in zip(part, [0, *at[:-1].tolist()], at.tolist()):
                (self if len(word) <= CACHED_CHARS and len(self) < CACHE_SIZE else passing)[word] = whole[a:b]
        return passing

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        tok, special = tokenizer(self.path), special_strings(self.path)
        if len(self) > CACHE_SIZE * 3 // 4:
            for word in list(islice(self, CACHE_SIZE // 2, None)):
                del self[word]
        words, found, unknown = [], [], set()
        for t in texts:
            if plain(t, special):
                words.append(WORD_LEVEL.findall(t.lower()))
                found.append(list(map(self.get, words[-1])))
                if None in found[-1]:
                    unknown.update([w for w, ids in zip(words[-1], found[-1]) if ids is None])
            else:
                words.append(())
                found.append([_le(tok.encode(t, add_special_tokens=False).ids)])
        if unknown:
            passing = self.learn(unknown)
            for own, ids in zip(words, found):
                if None in ids:
                    ids[:] = [(passing[w] if w in passing else self[w]) if x is None else x for w, x in zip(own, ids)]
        return list(map(b"".join, found))


_CACHES: dict[str, WordIds] = {}

#: A piece of a document: its id, tokens before it, ids, the document's tokens.
Piece = tuple[int | None, int, bytes, int]


def _cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[: n * ID], total), (doc, start + n, ids[n * ID :], total)


class Packer:
    """Packs the documents of one task; ``closed`` has the full windows as
    (window size, pieces)."""

    def __init__(self):
        self.pools: dict[int, list[Piece]] = {t: [] for t in TIERS}
        self.pooled = 0
        self.closed: list[tuple[int, list[Piece]]] = []

    def route(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        whole = len(ids) // ID // TIERS[0] * TIERS[0]
        for at in range(0, whole, TIERS[0]):
            self.closed.append((TIERS[0], [(doc, start + at, ids[at * ID : (at + TIERS[0]) * ID], total)]))
        if n := len(ids) // ID - whole:
            self.pools[min(t for t in TIERS if t >= n)].append((doc, start + whole, ids[whole * ID :], total))
            self.pooled += n

    def pack(self) -> None:
        """Closes windows until no window can be filled any more."""
        for i, tier in enumerate(TIERS):
            self.pools[tier].sort(key=lambda p: len(p[2]))
            for t in TIERS[i + 1 :]:
                self.pools[t].sort(key=lambda p: len(p[2]))
            while self.pools[tier] and self.pooled >= tier:
                first = self.pools[tier].pop()
                self._close(tier, first, tier - len(first[2]) // ID, TIERS[i + 1 :])

    def _close(self, tier: int, first: Piece, gap: int, shorter: tuple[int, ...]) -> None:
        pieces = [first]
        for t in shorter:
            while gap and self.pools[t] and len(self.pools[t][-1][2]) // ID <= gap:
                pieces.append(self.pools[t].pop())
                gap -= len(pieces[-1][2]) // ID
        while gap:  # what remains is cut; longer tiers have something only when they could not fill a window
            pool = next(self.pools[t] for t in (*shorter, tier, *TIERS) if self.pools[t])
            piece = pool.pop()
            n = min(gap, len(piece[2]) // ID)
            head, rest = _cut(piece, n)
            pieces.append(head)
            gap -= n
            if rest[2]:
                self.pools[min(t for t in TIERS if t >= len(rest[2]) // ID)].append(rest)
        self.pooled -= tier
        self.closed.append((tier, pieces))

    def finish(self) -> None:
        """What cannot fill a window any more, cut at powers of two."""
        self.pack()
        left = [p for t in TIERS for p in self.pools[t]]
        while self.pooled:
            size = 1 << (self.pooled.bit_length() - 1)
            pieces, gap = [], size
            while gap:
                piece = left.pop(0)
                n = min(gap, len(piece[2]) // ID)
                head, rest = _cut(piece, n)
                pieces.append(head)
                gap -= n
                if rest[2]:
                    left.insert(0, rest)
            self.pooled -= size
            self.closed.append((size, pieces))

    def steps(self, last: bool) -> Iterator[list[tuple[int, list[Piece]]]]:
        """Step groups of STEP_TOKENS tokens each, dealt from the long windows
        to the short: sizes are powers of two, so groups come out exactly
        even. Windows that do not make up a group wait for the next ones."""
        self.closed.sort(key=lambda w: -w[0])
        group, filled = [], 0
        for window in self.closed:
            group.append(window)
            filled += window[0]
            if filled == STEP_TOKENS:
                yield group
                group, filled = [], 0
        self.closed = group
        if last and group:
            yield group


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before
    it), ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``,
    ``sequence_id`` (unique), ``offset`` in the sequence, ``window`` (the
    sequence's size, all of it used) and ``step_group`` (sequences of a
    group hold STEP_TOKENS tokens together, but for a task's last one).

    A document's ids are the tokenizer's of its whole text, then ``end_id``;
    a null or empty text is ``end_id`` alone. A null doc_id stays null;
    repeated rows are packed each; an empty table gives no rows; other
    columns are not read.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _CACHES.setdefault(tokenizer_path, WordIds(tokenizer_path))
        end, packer = _le([end_id]), Packer()
        base = TaskContext.get().partitionId() << 33
        sequence = step = 0

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step
            for group in packer.steps(last):
                out = []
                for size, pieces in group:
                    offset = 0
                    for doc, start, ids, total in pieces:
                        n = len(ids) // ID
                        out.append((doc, start, n, ids, total, base + sequence, offset, size, base + step))
                        offset += n
                    sequence += 1
                step += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), _TYPES)], names=[f.name for f in _FIELDS]
                )

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), words.encode(texts)):
                    ids += end
                    packer.route((doc, 0, ids, len(ids) // ID))
                    if packer.pooled >= POOL_IDS:
                        packer.pack()
                    if packer.pooled >= POOL_IDS or len(packer.closed) >= 256:
                        yield from rows(False)
        packer.finish()
        yield from rows(True)

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(pack, SCHEMA)


_FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("window", pa.int32()), ("step_group", pa.int64()),
    ]
)
_TYPES = [f.type for f in _FIELDS]
