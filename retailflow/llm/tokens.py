"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact hash table of the corpus's frequent pre-tokens and
their token counts, broadcast to the workers. Tier 2 is a cache in each
worker for everything else: a pre-token met for the first time is encoded
once by the tokenizer and kept. No pre-token is shuffled: texts are counted
where they are read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.alphabet import BYTE_LEVEL, plain
from retailflow.llm.common import CACHE_SIZE, CACHED_CHARS

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


@cache
def tokenizer(path: str):
    """The library's tokenizer, read once per worker."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
    return Tokenizer.from_file(path)


@cache
def special_strings(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


class Lengths(dict):
    """Token counts of pre-tokens outside the frequent table."""

    def __init__(self, path: str):
        self.path = path

    def learn(self, pieces: list[str]) -> None:
        """Encodes ``pieces``, at most CACHE_SIZE different ones."""
        if len(self) + len(pieces) > CACHE_SIZE:
            self.clear()
        for i in range(0, len(pieces), 4096):
            part = pieces[i : i + 4096]
            self.update(zip(part, map(len, tokenizer(self.path).encode_batch(part, add_special_tokens=False))))

    def total(self, pieces: list[str]) -> int:
        """Tokens of ``pieces`` together. One longer than CACHED_CHARS is
        encoded each time and not kept."""
        n = sum(len(tokenizer(self.path).encode(p, add_special_tokens=False)) for p in pieces if len(p) > CACHED_CHARS)
        short = [p for p in pieces if len(p) <= CACHED_CHARS]
        for i in range(0, len(short), CACHE_SIZE):
            part = short[i : i + CACHE_SIZE]
            if new := {p for p in part if p not in self}:
                self.learn(list(new if len(self) + len(new) <= CACHE_SIZE else set(part)))
            n += sum(map(self.__getitem__, part))
        return n


_CACHES: dict[str, Lengths] = {}


def frequent_pre_tokens(
    docs: DataFrame, tokenizer_path: str, text: str = "text", size: int = 65_536, per_task: int = 8_192
) -> dict[str, int]:
    """The ``size`` most frequent pre-tokens of all texts with their token
    counts. Each task counts all its texts and hands on its ``per_task``
    most frequent ones of at most CACHED_CHARS characters; only these
    summaries are merged. The table has at most size x (CACHED_CHARS
    characters + one number): a few MB whatever the corpus. It decides which
    tier answers, never the answer."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, counts = special_strings(tokenizer_path), Counter()
        for batch in batches:
            for value in batch.column(0):
                if (t := value.as_py()) and plain(t, special):
                    counts.update(BYTE_LEVEL.findall(t))
            if len(counts) > 64 * per_task:
                counts = Counter(dict(counts.most_common(16 * per_task)))
        top = [(k, n) for k, n in counts.most_common(per_task) if len(k) <= CACHED_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    rows = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(summarise, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(size)
        .collect()
    )
    lengths = Lengths(tokenizer_path)
    pieces = [r.piece for r in rows]
    lengths.learn(pieces)
    return dict(lengths)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", size: int = 65_536
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per input row: UTF-8 bytes and tokens
    of the whole text as the ``tokenizers`` library counts them, without
    added special tokens; a special string inside a text is one token, as is
    the library's default.

    Null text counts as empty (0, 0). A null id is passed through, repeated
    rows are counted each, an empty table gives an empty result, and other
    columns of ``docs`` are not read. A very long text is one row in memory
    of one worker.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(docs, tokenizer_path, "text", size))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, special = frequent.value, special_strings(tokenizer_path)
        rest = _CACHES.setdefault(tokenizer_path, Lengths(tokenizer_path))

        def tokens(t: str) -> int:
            if not plain(t, special):
                return len(tokenizer(tokenizer_path).encode(t, add_special_tokens=False))
            pieces = BYTE_LEVEL.findall(t)
            found = list(map(table.get, pieces))
            if None not in found:
                return sum(found)
            missed = [p for p, n in zip(pieces, found) if n is None]
            return sum(filter(None, found)) + rest.total(missed)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                    pa.array(map(tokens, texts), pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.mapInArrow(count, SCHEMA)
